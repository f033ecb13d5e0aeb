"""Schemas of the records that are read, and the versions that are understood."""

from __future__ import annotations

VERSIONS = (1, 2)
PAGE = "struct<page_number:int,text:string,char_count:int,text_source:string,indexable:boolean,ocr:struct<text:string,accepted:boolean,engine:string>,quality:struct<verdict:string,reason:string>,language:struct<verdict:string,reason:string>>"
SOURCE = "struct<document_id:string,category:string,document_type:string,title:string,pdf_relpath:string,sha256:string,bytes:bigint,source_url:string,handle:string,jurisdiction:string,year:int,enactment_date:string>"
PROCESSED = f"schema_version int, source {SOURCE}, extraction struct<page_count:int,pdf_type:string>, pages array<{PAGE}>, structure struct<confidence:string,line_count:int>"
LISTING = "document_id string, title string, document_type string, jurisdiction string, year int, collection_name string, enactment_date string"
QUESTION = (
    "question_id string, question string, category string, answer_type string, jurisdiction_hint string,"
    "gold_evidence array<struct<group_id:string,requirement:string,locations:array<struct<document_id:string,key:string,citation:string,unit_path:array<struct<unit_type:string,number:string>>,char_start:bigint,char_end:bigint,page_start:int,page_end:int,text_sha256:string,evidence_confidence:string,source:string>>>>,"
    "proposed_alternatives array<string>, gold_answer string, required_facts array<array<string>>, must_cite array<struct<document_id:string,key:string>>, unanswerable boolean, difficulty struct<char_count:bigint,cluster_size:int>, provenance struct<status:string,sample_index:bigint,verified_at:timestamp>"
)
PREDICTIONS = "system string, split string, predictions map<string,map<string,array<array<string>>>>"
LABELS = "document_id string, page_number int, label string, legal_critical_errors string, notes string"
TARGETS = "url string, type string, parent_url string"
JOURNAL = "document_id string, status string, attempt int, sha256 string, processed_at timestamp, reasons array<string>, bytes bigint, pages int"

"""Word lists and thresholds that results depend on."""

from __future__ import annotations

# Words without a retrieval signal.
STOPWORDS = tuple("a and any as be by for in is may of on or shall such the to under".split())

# English function words, with the connectives of legal drafting.
FUNCTION_WORDS = tuple(
    """
a an the and or but if then than that this these those of to in on at by for
with from as is are was were be been being am has have had do does did not no
nor so such which who whom whose what when where why how all any both each few
more most other some only own same too very can will just shall should may
might must would could it its he she her him his they them their there here
under over above below after before between into during without within upon
against about out off again further once because while until unless whether
either neither also per said thereof therein thereto thereunder thereafter
thereby hereby herein hereof hereto hereunder hereinafter notwithstanding
provided subject respectively aforesaid whereas whereof wherein whereby
accordingly otherwise pursuant every another one two three four five six seven
eight nine ten first second third
""".split()
)

# Words of statutory drafting.
LEGAL_WORDS = tuple(
    """
act acts section sections subsection subsections clause clauses rule rules
regulation regulations schedule schedules chapter chapters part parts article
articles preamble proviso provisos explanation explanations
government governments state states central union territory territories
district districts court courts judge judges magistrate magistrates tribunal
authority authorities officer officers board committee commission council
person persons party parties company companies society societies
prescribed notification notifications order orders power powers apply applies
application applicable appoint appointed appointment commencement extent
title short repeal repealed savings amendment amended amend substituted
inserted omitted penalty penalties punishment punishable offence offences fine
fines imprisonment period periods date dates year years month months day days
appeal appeals revision inquiry enquiry hearing evidence witness document
documents register registered registration licence license permit certificate
india indian public private service services provision provisions force effect
made make making respect purpose purposes behalf manner conditions terms
payment payable tax taxes duty duties fee fees property land premises
""".split()
)

COMMON_WORDS = tuple(sorted({*FUNCTION_WORDS, *LEGAL_WORDS}))

# Words of titles that don't tell instruments apart.
TITLE_STOPWORDS = ("the", "of", "and", "no", "a", "an", "for", "in", "to")

# Thresholds of the quality panel, and the weight of each check.
QUALITY = dict(mean_word_length=4.2, single_char_rate=0.12, mixed_case_rate=0.01, alnum_mix_rate=0.035, common_word_rate=0.28, alpha_ratio=0.5, symbol_ratio=0.06, vowelless_ratio=0.15, min_words=60, page_words=60, suspect_ratio=0.3, good=0.8, questionable=0.55)
WEIGHTS = dict(mean_word_length=2.0, single_char_rate=2.0, mixed_case_rate=2.0, alnum_mix_rate=1.5, alpha_ratio=1.0, common_word_rate=1.0, symbol_ratio=1.0, vowelless_ratio=1.0, page_consistency=1.0, replacement_characters=1.0)

# Thresholds of the language rules.
LANGUAGE = dict(min_words=150, short_words=60, short_rate=0.3, english=0.15, non_english=0.08, distinct=12, non_latin=0.25, letters=200, line_letters=10, mangled_words=40, mixed=0.15)

# Bounds of the era and size bands.
ERAS = (("pre_1900", 1899), ("1900_1949", 1949), ("1950_1990", 1990), ("1991_2010", 2010))
SIZES = (("tiny", 100 * 1024), ("small", 500 * 1024), ("medium", 2 * 1024**2), ("large", 8 * 1024**2))

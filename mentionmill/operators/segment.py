"""The simple abbreviation-aware splitter, surface filters and cue tags, all as Column expressions over words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionmill.functions import text as T

# Abbreviations whose point is no end. A point within one stands for any character.
ABBREVIATIONS = (
    "e.g", "i.e", "et al", "vs", "fig", "figs", "eq", "eqs", "ref", "refs", "approx", "ca", "cf", "no", "vol", "nos", "sp", "ssp",
    "gen", "dr", "prof", "mr", "mrs", "ms", "st", "jr", "sr", "al", "inc", "ltd", "co", "dept", "univ", "p.o", "i.v", "i.p", "s.c",
    "i.c.v", "q.d", "b.i.d", "t.i.d",
)
_SHORTENED = rf"(?iU)\b(?:{'|'.join(ABBREVIATIONS)})\.$"
_INITIAL = r"(?U)\b[A-Z]\.$"
_STARTS = r'^["“(\[]?[A-Z0-9]'


def split(text: Column) -> Column:
    """Sentences of English prose as an array; null and blank texts give none.

    Every word with an end mark at its end is tested: the next word must look like a beginning, and the word itself must be neither
    an abbreviation nor an initial. The words between two ends are a sentence.
    """
    words = F.split(T.squeeze(text), " ")
    ends = lambda w, i: w.rlike("[.!?]$") & ~w.rlike(_SHORTENED) & ~w.rlike(_INITIAL) & F.get(words, i + 1).rlike(_STARTS)
    tested = F.transform(words, lambda w, i: F.when(ends(w, i), i + 1))
    starts = F.concat(F.array(F.lit(0)), F.array_compact(tested))
    stops = F.concat(F.array_compact(tested), F.array(F.size(words)))
    parts = F.zip_with(starts, stops, lambda a, b: F.array_join(F.slice(words, a + 1, b - a), " "))
    return F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda p: p != "")


def surface_faults(text: Column) -> Column:
    """Names of what keeps a text from being a sentence, in alphabetical order; none for a sentence, and none known of null."""
    s = F.trim(text)
    words = F.size(F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""))
    wanted = {
        "end mark": s.rlike(r"[.!?][\"’”)\]]*$"), "few letters": T.alpha_ratio(s) >= 0.5, "few plain words": F.regexp_count(s, F.lit("[A-Za-z]{2,}")) >= 2, "few words": words >= 4,
        "no small letter": s.rlike(r"\p{Ll}"), "short": F.length(s) >= 25, "start": s.rlike(r'^["“(\[A-Z0-9]'),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in sorted(wanted.items())]))


def is_sentence(text: Column) -> Column:
    """Long enough, mostly letters, with a clean start, an end mark and a small letter; null is none."""
    return text.isNotNull() & (F.size(surface_faults(text)) == 0)


# The words and phrases of each cue group, the patterns of statistics, and phrases of prior work and references.
CUE_WORDS = {
    "finding": (
        "found", "observed", "identified", "detected", "revealed", "showed", "shown", "demonstrated", "indicated", "exhibited", "displayed", "confirmed", "noted", "measured", "quantified",
        "determined", "yielded", "resulted in",
    ),
    "change": (
        "increased", "decreased", "reduced", "elevated", "enhanced", "diminished", "declined", "higher", "lower", "greater", "upregulated", "up-regulated", "downregulated", "down-regulated",
        "overexpressed", "suppressed", "induced", "inhibited", "enriched", "depleted", "significantly",
    ),
    "relation": ("associated with", "correlated with", "linked to", "compared with", "compared to", "relative to", "versus", "vs", "no significant difference", "significant"),
}
STATISTICS = (r"\bp\s*[<=>]\s*0?\.\d+", r"\b\d+(\.\d+)?\s*%", r"\bn\s*=\s*\d+", r"\b\d+(\.\d+)?[- ]?fold\b", "±", r"\b95\s*%\s*ci\b", r"\b(or|hr|rr)\s*=\s*\d", r"\br\s*=\s*-?0?\.\d+")
PRIOR_WORK = (
    "ha(s|ve) been (shown|reported|demonstrated|described|associated)", "it has been", "previously (shown|reported|demonstrated|described|observed)", "previous(ly)? studies", "prior studies",
    "earlier studies", "other studies", "studies have (shown|reported|demonstrated)", "it is (well )?known", "are known to",
)
REFERENCES = ("https?://", r"\bdoi:\s*10\.", r"doi\.org", r"www\.")

#: One pattern per group, of its words and phrases as whole words.
CUES = {name: rf"\b(?:{'|'.join(words)})\b" for name, words in CUE_WORDS.items()} | {"stat": "|".join(STATISTICS)}


def cues(text: Column) -> Column:
    """Names of the cue groups that a sentence holds, in a fixed order."""
    return F.array_compact(F.array(*[F.when(text.rlike("(?i)" + p), n) for n, p in CUES.items()]))


def is_prior(text: Column) -> Column:
    """Speaks of earlier work or gives an address."""
    return F.coalesce(text.rlike("(?i)" + "|".join(REFERENCES)) | text.rlike(rf"(?i)\b(?:{'|'.join(PRIOR_WORK)})\b"), F.lit(False))

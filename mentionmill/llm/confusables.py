"""Visually identical text in one canonical form.

The quick-check properties of normalization tell, character by character, what is stable: a character is unstable if compatibility
composition changes it (quick check No), if it may join with what stands before it (Maybe: combining marks, but also vowels and
finals of Hangul and vowel signs of Indic scripts), if it or what it decomposes into looks like a letter of another script, if it
cannot be seen, or if it is a blank. Only runs of unstable characters are normalized, together with the last stable character
before them as boundary context; the results are spliced into the unchanged rest. Letter case, spelling and visible blanks and
hyphens stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mentionmill.session import ship

# Letters of other scripts that look like a Latin letter, each followed by that letter. A fuller table may be given.
_GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ρp ιi υu χx ϲc ϳj ϹC ͿJ"
_CYRILLIC = "АA ВB ЕE ІI ЈJ КK МM НH ОO РP СC ТT УY ҮY ХX ЅS ԚQ ԜW ӀI ԌG аa гr еe ҽe һh іi јj оo рp сc ԛq ѕs уy үy хx ѵv ԝw ѡw ԁd ӏl"
_ARMENIAN = "ՍU ՏS Օ0 օo սu ոn հh ցg քp զq յj"
_COPTIC = "ⲂB ⲎH ⲒI ⲔK ⲘM ⲚN ⲞO ⲟo ⲢP ⲣp ⲤC ⲥc ⲦT ⲨY ⲬX"
_CHEROKEE = "ᎠD ᎡR ᎢT ᎥiᎩY ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᎽY ᏀG ᏂhᏃZ ᏏbᏒR ᏔW ᏕS ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK ᏧdᏳG ᏴB"
_LISU = "ꓐB ꓑP ꓒdꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU"
_LATIN = "ıi ɩi ɪi ȷj ɡg ᴄc ᴏo ꜱs ᴜu ʋu ᴠv ᴡw ʏy ᴢz ɑα"
# Other signs that look like a letter or hyphen used in names.
_SIGNS = "ꞵβ ɣγ кκ ĸκ ‐- ‑- ‒- –- −- ﹣- ⁃- ˗- ’' ‘' ʼ' ′' ＇'"


def _pairs(*parts: str) -> dict[str, str]:
    signs = "".join(parts).replace(" ", "")
    return dict(zip(signs[::2], signs[1::2], strict=True))


LOOKS_LIKE = _pairs(_GREEK, _CYRILLIC, _ARMENIAN, _COPTIC, _CHEROKEE, _LISU, _LATIN, _SIGNS)

_RUN = re.compile(r"[^ -~]+")
_ODD = r"[^ -~]|^ | $"
#: A sharp s stands for the Greek letter unless a small Latin letter is directly beside it, as in German words.
_SHARP = re.compile(r"(?<![a-zà-öø-ſ])ß(?![a-zà-öø-ſ])")


def read_lookalikes(path: str) -> dict[str, str]:
    """A table in the public format ``source ; target ; type`` of hexadecimal code points; sources of one character beyond ASCII.

    Letters that the own table keeps apart (α, γ, δ, κ, and 1, l, I) stay apart.
    """
    out = dict(LOOKS_LIKE)
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            cells = line.split("#")[0].split(";")
            if len(cells) >= 2 and len(source := cells[0].split()) == 1 and (c := chr(int(source[0], 16))) > "\x7f" and c not in "αβγδκ":
                out.setdefault(c, "".join(chr(int(x, 16)) for x in cells[1].split()))
    return {c: x for c, x in out.items() if c != x}


def invisible(c: str) -> bool:
    """Default-ignorable characters: format controls, joiners, variation selectors, fillers, soft hyphens."""
    o = ord(c)
    return unicodedata.category(c) in ("Cf", "Cc") and c not in "\t\n\r\v\f" or 0xFE00 <= o <= 0xFE0F or o in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0x180B <= o <= 0x180F or 0xE0000 <= o <= 0xE0FFF


@cache
def may_join() -> frozenset[str]:
    """Characters that composition may join with the one before them (quick check Maybe), from the canonical decompositions."""
    out = {chr(x) for x in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # Hangul composes by rule
    for o in range(0xA0, 0x20000):
        parts = unicodedata.decomposition(chr(o)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.is_normalized("NFC", chr(o)):
            out.add(chr(int(parts[1], 16)))
    return frozenset(out)


class Form:
    """The canonical form under one table of look-alikes."""

    def __init__(self, table: dict[str, str] = LOOKS_LIKE):
        self.table = table
        self._known: dict[str, bool] = {}

    def stable(self, c: str) -> bool:
        """No normalization changes the character or joins it with what stands before it, and it looks like no other."""
        known = self._known.get(c)
        if known is None:
            known = unicodedata.is_normalized("NFKC", c) and not unicodedata.combining(c) and c not in may_join() and not invisible(c) and not c.isspace()
            known = self._known[c] = known and not any(k in self.table for k in unicodedata.normalize("NFKD", c))
        return known

    def _fold(self, segment: str) -> str:
        table = self.table
        bare = "".join(c for c in unicodedata.normalize("NFKD", segment) if not invisible(c))
        out = "".join(table.get(c, " " if c.isspace() else c) for c in bare)
        return unicodedata.normalize("NFC", out)

    def of(self, text: str) -> str:
        """The form that all texts of the same look share; blanks at the ends cannot be seen and go."""
        if text.isascii() and text.isprintable():
            return text.strip()
        out, at, stable = [], 0, self.stable
        for m in _RUN.finditer(text):
            i, end = m.span()
            while i < end:
                if stable(text[i]):
                    i += 1
                    continue
                start = max(at, i - 1)  # what stands here is stable, so nothing before it takes part
                while i < end and not stable(text[i]):
                    i += 1
                out += [text[at:start], self._fold(text[start:i])]
                at = i
        out.append(text[at:])
        x = "".join(out)
        return (_SHARP.sub("β", x) if "ß" in x else x).strip()


_own = Form()
canonical: Callable[[str], str] = _own.of


def canonical_column(c: Column, form: Form = _own) -> Column:
    """``Form.of`` of a text column; null stays null. It is evaluated once, where it stands: no filter is pushed below it."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(form.of, na_action="ignore")

    return F.pandas_udf(run, StringType()).asNondeterministic()(c)


def unstable(c: Column) -> Column:
    """Whether a text can differ from its canonical form: cheap and without Python."""
    return c.rlike(_ODD)


def looks_like(texts: DataFrame, names: DataFrame, table: dict[str, str] = LOOKS_LIKE) -> DataFrame:
    """(all columns of ``texts``, plain): listed names that a text looks like but does not equal.

    ``texts`` has ``kind`` and ``text``, ``names`` has ``kind`` and ``name``. Null and blank texts look like nothing; a text that
    looks like several listed names gives a row for each; repeated texts give repeated rows; a column ``plain`` of ``texts`` is
    replaced, other columns pass through whatever their names. Only texts with characters beyond
    plain printable ones go through Python, unless some listed name has such characters in an unstable form.
    """
    ship(texts.sparkSession)
    form = Form(table)
    listed = names.where("name is not null").select("kind", "name").distinct().withColumn("_form", canonical_column(F.col("name"), form)).where("_form <> ''")
    odd_names = listed.where(F.col("name") != F.col("_form")).limit(1).count() > 0
    x = texts.drop("plain").where("text is not null")
    x = x if odd_names else x.where(unstable(F.col("text")))
    x = x.select(F.struct("*").alias("_row"), "kind", canonical_column(F.col("text"), form).alias("_form"))
    x = x.join(listed, ["kind", "_form"]).where(F.col("name") != F.col("_row.text"))
    return x.select("_row.*", F.col("name").alias("plain"))

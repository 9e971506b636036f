"""Freely written values mapped to the closest entry of a reference list; what matches nothing is reported.

The reference names form a symmetric-delete dictionary: every word of every name, less up to two letters, points back to the
word. The list is counted first; up to ``max_names`` names it is sent to every task once, and values are looked up where they lie,
without a shuffle, each distinct value once per task. A longer list goes through in blocks of about that many names, one at a time
on the driver, against the distinct values; the words of the whole list that a value holds come from a join, and the best candidates
of all blocks are compared.

A value is tried in this order, and the first hit ranks it: as written; in canonical form; folded (case, accents, separators,
Greek letters as words); without separators; as a set of singular American words (any order, "of the" left out); each of these
without added qualifiers; and last with unknown words corrected. Only words that no name has are corrected, by as many edits as the
word of the list allows by its length and ``Rules.max_edits`` in all, so a number, a code or another known word never turns into
something else. Candidates rank by weighted Damerau-Levenshtein distance, then by the weight of the name's field, how often the
list's entry is meant elsewhere, and its id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.llm.confusables import canonical
from mentionmill.session import ship
from mentionmill.staging import staged

UNMATCHED = "unmatched"
#: Names in one dictionary: about 3 kB each with all their deletes, so at most some 150 MB per task.
MAX_NAMES = 50_000
#: Letters of a text up to which its answers are kept for its repeats; longer ones are worked out anew, so that memory stays bounded.
KEPT = 500
# Greek letters with their English names.
_GREEK = "α alpha β beta γ gamma δ delta ε epsilon ζ zeta η eta θ theta ι iota κ kappa λ lambda μ mu ν nu ξ xi ο omicron π pi ρ rho σ sigma ς sigma τ tau υ upsilon φ phi χ chi ψ psi ω omega".split()
GREEK = dict(zip(_GREEK[::2], _GREEK[1::2], strict=True))
# British letters in words and their American form.
BRITISH = (("haem", "hem"), ("oedema", "edema"), ("oesoph", "esoph"), ("tumour", "tumor"), ("anaem", "anem"), ("leukaem", "leukem"), ("aemia", "emia"), ("sulph", "sulf"), ("paed", "ped"), ("foet", "fet"))
# Words that a name may drop or add without meaning something else.
SMALL_WORDS = frozenset("of the with in a an and".split())


@dataclass(frozen=True)
class Rules:
    """What may differ between a value and the name it means.

    ``before`` and ``after`` have, by kind, the words that may be added in front of and behind a name. A word of the list may be met
    by one edit from ``one_edit`` letters on and by two from ``two_edits`` on, with ``max_edits`` in a whole value. A value whose only
    word, apart from small words, Greek letters and single letters, has at most ``symbol_letters`` letters is a symbol; words with
    digits, and words with several capitals that are that short or stand among small letters, are codes. Neither is corrected.
    """

    before: Mapping[str, frozenset[str]] = field(default_factory=dict)
    after: Mapping[str, frozenset[str]] = field(default_factory=dict)
    one_edit: int = 4
    two_edits: int = 8
    max_edits: int = 2
    symbol_letters: int = 6


_BRACKET = re.compile(r"\s*[(\[]([^()\[\]]*)[)\]]\s*$")
_WORD = re.compile(r"[^\W_]+")
_BARE = frozenset(GREEK.values())


def fold(text: str) -> str:
    """Words of the canonical form in lower case, without accents, Greek letters spelled out."""
    return _kept_fold(text) if len(text) <= KEPT else _fold(text)


def _fold(text: str) -> str:
    x = "".join(f" {GREEK[c]} " if c in GREEK else c for c in canonical(text).lower())
    x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return " ".join(_WORD.findall(x))


_kept_fold = lru_cache(10_000)(_fold)


def singular(w: str) -> str:
    if len(w) > 4 and w.endswith("ies"):
        return w[:-3] + "y"
    if len(w) > 4 and w.endswith("oses"):
        return w[:-2] + "is"
    return w[:-1] if len(w) > 3 and w.endswith("s") and not w.endswith(("ss", "us", "is")) else w


def american(w: str) -> str:
    for a, b in BRITISH:
        w = w.replace(a, b)
    return w


def word_set(folded: str) -> str:
    return " ".join(sorted(singular(american(w)) for w in folded.split() if w not in SMALL_WORDS))


def deletes(w: str, edits: int) -> set[str]:
    out, edge = {w}, {w}
    for _ in range(edits):
        edge = {x[:i] + x[i + 1 :] for x in edge for i in range(len(x))}
        out |= edge
    return out


def distance(a: str, b: str) -> float:
    """Weighted Damerau-Levenshtein: swapped neighbours and doubled letters cost .7, one vowel for another .8, the first letter .2 more."""
    inf = float("inf")
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i and not j:
                continue
            first = 0.2 if i <= 1 and j <= 1 else 0.0
            best = inf
            if i:
                best = rows[i - 1][j] + (0.7 if i > 1 and a[i - 1] == a[i - 2] else 1.0) + first
            if j:
                best = min(best, rows[i][j - 1] + (0.7 if j > 1 and b[j - 1] == b[j - 2] else 1.0) + first)
            if i and j:
                x, y = a[i - 1], b[j - 1]
                best = min(best, rows[i - 1][j - 1] + (0.0 if x == y else 0.8 if x in "aeiouy" and y in "aeiouy" else 1.0 + first))
                if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                    best = min(best, rows[i - 2][j - 2] + 0.7)
            rows[i][j] = best
    return rows[-1][-1]


class Names:
    """The dictionary of one kind: entries are (not usable, field rank, -frequency, id)."""

    def __init__(self, kind: str, names: list[tuple[str, tuple]], rules: Rules):
        self.kind, self.rules = kind, rules
        self.written: dict[str, tuple] = {}
        self.canonical: dict[str, tuple] = {}
        self.folded: dict[str, tuple] = {}
        self.joined: dict[str, tuple] = {}
        self.sets: dict[str, tuple] = {}
        near: dict[str, set[str]] = defaultdict(set)
        self.known: set[str] = set()
        self.of_form: dict[str, str] = {}  # a word as a name writes it, and as the dictionary has it
        for name, entry in names:
            f = fold(name)
            s = word_set(f)
            for at, key in ((self.written, name), (self.canonical, canonical(name)), (self.folded, f), (self.joined, f.replace(" ", "")), (self.sets, s)):
                if key and (key not in at or entry < at[key]):
                    at[key] = entry
            self.known.update(s.split())
            for w in map(american, f.split()):
                if w not in SMALL_WORDS:
                    self.of_form[w] = self.of_form[singular(w)] = singular(w)
        for w in self.of_form:
            if not any(c.isdigit() for c in w):
                for x in deletes(w, self._allowed(len(w))):
                    near[x].add(w)
        self.near = dict(near)

    def _allowed(self, letters: int) -> int:
        """Edits by which a word of the list with so many letters may be met."""
        return min(self.rules.max_edits, 2 if letters >= self.rules.two_edits else 1 if letters >= self.rules.one_edit else 0)

    def exact(self, text: str) -> tuple | None:
        """(rank, entry) of a text that needs no correction."""
        if e := self.written.get(text):
            return 0, e
        if e := self.canonical.get(canonical(text)):
            return 1, e
        f = fold(text)
        if e := self.folded.get(f):
            return 2, e
        if e := self.joined.get(f.replace(" ", "")):
            return 3, e
        e = self.sets.get(word_set(f))
        return (4, e) if e else None

    def trimmed(self, text: str) -> Iterator[str]:
        """The text with fewer and fewer added qualifiers."""
        x = canonical(text)
        while m := _BRACKET.search(x):
            x = x[: m.start()]
            yield x
        w = fold(x).split()
        before, after = self.rules.before.get(self.kind, frozenset()), self.rules.after.get(self.kind, frozenset())
        lo, hi = 0, len(w)
        while hi - lo > 1 and w[hi - 1] in after:
            hi -= 1
            yield " ".join(w[lo:hi])
        while hi - lo > 1 and w[lo] in before:
            lo += 1
            yield " ".join(w[lo:hi])

    def consistent(self, text: str, entry: tuple, known: set[str]) -> bool:
        """A bracket with a number in it must itself mean the entry, else it names another thing."""
        m = _BRACKET.search(canonical(text))
        if not m or not any(c.isdigit() for c in m.group(1)):
            return True
        hit = self.exact(m.group(1)) or self.corrected(m.group(1), known)
        return hit is not None and hit[-1][-1] == entry[-1]

    def _codes(self, text: str) -> set[str]:
        """The folded words of a text that are codes, or all if it is a symbol."""
        x = canonical(text)
        short = self.rules.symbol_letters
        words = fold(x).split()
        content = [w for w in words if len(w) > 1 and w not in _BARE and w not in SMALL_WORDS]
        if len(content) == 0 or len(content) == 1 and len(content[0]) <= short:
            return set(words)
        small = any(c.islower() for c in x)
        return {fold(w) for w in _WORD.findall(x) if sum(c.isupper() for c in w) > 1 and (small or len(w) <= short)} | {w for w in words if any(c.isdigit() for c in w)}

    def corrected(self, text: str, known: set[str]) -> tuple | None:
        """(distance, entry) after correcting words that no name has."""
        options: list[list[tuple[float, int, str]]] = []
        codes = self._codes(text)
        wrong = 0
        for w in fold(text).split():
            if w in SMALL_WORDS:
                continue
            a = american(w)
            s = singular(a)
            if s in known or w in codes:
                options.append([(0.0, 0, s)])
                continue
            wrong += 1
            if wrong > self.rules.max_edits:
                return None  # every wrong word takes an edit
            found: dict[str, tuple[float, int]] = {}
            for form in {w, a, s}:
                most = self._allowed(len(form) + self.rules.max_edits)  # no word met by two edits is longer
                for v in {v for x in deletes(form, most) for v in self.near.get(x, ())}:
                    if abs(len(form) - len(v)) <= (allowed := self._allowed(len(v))) and (k := _edits(form, v)) <= allowed:
                        n = self.of_form[v]
                        found[n] = min(found.get(n, (9.0, 9)), (distance(form, v), k))
            if not found:
                return None
            options.append(sorted((d, k, v) for v, (d, k) in found.items()))
        best = None
        for combo in product(*options):
            d = sum(c[0] for c in combo)
            if sum(c[1] for c in combo) <= self.rules.max_edits and (e := self.sets.get(" ".join(sorted(c[2] for c in combo)))) and (best is None or (d, e) < best):
                best = d, e
        return best

    def closest(self, text: str, known: set[str] | None = None) -> tuple | None:
        """(rank, distance, entry) of the entry that a text means, or nothing; ``known`` are the words that any name has."""
        known = self.known if known is None else known
        if not text or not text.strip():
            return None
        if hit := self.exact(text):
            return hit[0], 0.0, hit[1]
        for i, x in enumerate(self.trimmed(text)):
            if hit := self.exact(x):
                return (5 + i, 0.0, hit[1]) if self.consistent(text, hit[1], known) else None
        for i, x in enumerate((text, *self.trimmed(text))):
            if hit := self.corrected(x, known):
                return (50 + i, *hit) if self.consistent(text, hit[1], known) else None
        return None


def list_words(text: str) -> set[str]:
    """The words of a text as the dictionary has them."""
    return {singular(american(w)) for w in fold(text).split()}


def _edits(a: str, b: str) -> int:
    """Unweighted distance, for the bound."""
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            k = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                k = min(k, two[j - 2] + 1)
            row.append(k)
        two, one = one, row
    return one[-1]


def _look_up(shared, keep: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_kind: dict[str, Names] = shared.value
        seen: dict[tuple, tuple | None] = {}
        for b in batches:
            if len(seen) > 500_000:
                seen.clear()
            out = []
            known = b["known"] if "known" in b else [None] * len(b)
            for kind, text, words in zip(b["kind"], b["text"], known, strict=True):
                hit = seen.get((kind, text), seen)  # the dictionary itself stands for what is not in it
                if hit is seen:
                    names = by_kind.get(kind)
                    hit = names.closest(text, None if words is None else set(words)) if names and isinstance(text, str) else None
                    if not isinstance(text, str) or len(text) <= KEPT:
                        seen[kind, text] = hit
                out.append(hit)
            x = b[keep].copy()
            x["rank"] = pd.array([h[0] if h else None for h in out], dtype="Int32")
            x["distance"] = pd.array([h[1] if h else None for h in out], dtype="Float64")
            x["blocked"] = pd.array([h[2][0] if h else None for h in out], dtype="boolean")
            x["field_rank"] = pd.array([h[2][1] if h else None for h in out], dtype="Int32")
            x["minus"] = pd.array([h[2][2] if h else None for h in out], dtype="Int64")
            x["ref_id"] = [h[2][3] if h else None for h in out]
            yield x

    return run


def _words_of(column: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, t, w) for k, t in zip(b["kind"], b[column], strict=True) for w in list_words(t)]
            yield pd.DataFrame(rows, columns=["kind", "of", "word"])

    return run


def _texts_with_known_words(values: DataFrame, names: DataFrame) -> DataFrame:
    """(kind, text, known): each distinct value with those of its words that any name of its kind has."""
    texts = staged(values.select("kind", "text").where("kind is not null and text is not null").distinct(), "texts")
    schema = "kind string, of string, word string"
    vocabulary = names.select("kind", "name").distinct().mapInPandas(_words_of("name"), schema).select("kind", "word").distinct()
    hits = texts.mapInPandas(_words_of("text"), schema).join(vocabulary, ["kind", "word"])
    known = hits.groupBy("kind", F.col("of").alias("text")).agg(F.collect_set("word").alias("known"))
    x = texts.join(known, ["kind", "text"], "left")
    return staged(x.select("kind", "text", F.coalesce("known", F.array().cast("array<string>")).alias("known")), "known")


def closest_entries(values: DataFrame, key: list[str], names: DataFrame, frequency: DataFrame | None = None, rules: Rules = Rules(), max_names: int = MAX_NAMES) -> DataFrame:
    """The columns ``key`` of ``values`` with ``ref_id`` and ``distance``: the entry meant, or ``unmatched`` with null distance.

    ``values`` has ``kind`` and ``text`` besides ``key``. ``names`` has ``kind``, ``ref_id``, ``name``, ``field_rank`` and
    ``blocked``; a value that means a blocked entry, and no other as well, is unmatched. ``frequency`` has (ref_id, n). Null,
    blank and unknown-kind values are unmatched; repeated values are answered alike; an empty list leaves all unmatched.
    """
    spark = values.sparkSession
    ship(spark)
    x = names.groupBy("kind", "name", "ref_id").agg(F.min("field_rank").alias("field_rank"), F.min("blocked").alias("blocked"))
    if frequency is not None:
        x = x.join(frequency, "ref_id", "left")
    x = x.select("kind", "name", "ref_id", "field_rank", "blocked", F.coalesce(F.col("n") if frequency is not None else F.lit(None).cast("bigint"), F.lit(0)).alias("n"))
    x = staged(x, "names")
    blocks = -(-x.count() // max_names)  # counted before anything is fetched
    answer = "rank int, distance double, blocked boolean, field_rank int, minus bigint, ref_id string"

    def looked_up(rows: DataFrame, of: DataFrame, keep: list[str]) -> DataFrame:
        kinds: dict[str, list] = defaultdict(list)
        for r in rows.toLocalIterator():
            kinds[r.kind].append((r.name, (bool(r.blocked), r.field_rank, -r.n, r.ref_id)))
        shared = spark.sparkContext.broadcast({kind: Names(kind, v, rules) for kind, v in kinds.items()})
        schema = ", ".join(f"`{k}` {dict(of.dtypes)[k]}" for k in keep)
        return of.mapInPandas(_look_up(shared, keep), f"{schema}, {answer}")

    if blocks <= 1:
        found = looked_up(x, values.select(*key, "kind", "text"), key)
    else:
        texts = _texts_with_known_words(values, x)
        each = None
        for i in range(blocks):  # the names of one entry stay together
            f = looked_up(x.where(F.pmod(F.xxhash64("kind", "ref_id"), F.lit(blocks)) == i), texts, ["kind", "text"])
            each = f if each is None else each.unionByName(f)
        order = F.struct("rank", "distance", "blocked", "field_rank", "minus", "ref_id")
        best = each.groupBy("kind", "text").agg(F.min(F.when(F.col("rank").isNotNull(), order)).alias("b"))
        v = values.select(F.struct(*key).alias("_key"), "kind", "text")
        found = v.join(best, ["kind", "text"], "left").select("_key.*", "b.*")
    hit = F.col("ref_id").isNotNull() & ~F.col("blocked")
    return found.select(*[F.col(f"`{k}`") for k in key], F.when(hit, F.col("ref_id")).otherwise(UNMATCHED).alias("ref_id"), F.when(hit, F.col("distance")).alias("distance"))

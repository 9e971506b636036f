"""Evaluation texts inside training texts, found with generalised suffix automata of the test items.

Test items are normalised and laid in blocks, each with one suffix automaton of all its items. Documents stream through once,
whatever the number of blocks: fingerprints of all item runs of the minimum length tell which blocks can share a run with a document
at all, and the automata of just those read its units. After each unit the state tells the longest suffix that stands in any item,
so all shared runs of at least the minimum come out, with their place, without comparing a document with an item.

Units are words, or letters for items in scripts without blanks between words. Case, punctuation, blanks, line ends, the form of
characters (compatibility forms, combining marks, digits of other scripts, invisible characters) and words broken over a line end
make no difference; a token of which nothing remains in that form is no word.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.session import ship

#: Shared units that make a case, in words and in letters.
MIN_WORDS, MIN_LETTERS = 12, 24
#: Languages whose items are compared letter by letter.
LETTERWISE = ("zh", "ja", "th", "yue", "lo", "km", "my")
#: Most characters of the items of one automaton: about 20 MB, built where it is needed in about a tenth of a second.
MAX_UNITS = 200_000
#: Automata that a task holds at once.
HELD = 8
#: Most characters of the items that go through in one pass; a task gets at most about 100 MB of words and fingerprints.
MAX_SCAN = 8_000_000

UNKNOWN, NOTHING = -1, -2


def _ranges(test, upto: int) -> str:
    """The characters that pass a test, as ranges of a pattern's class."""
    out, start = [], None
    for o in range(upto + 1):
        passes = o < upto and test(chr(o))
        if passes and start is None:
            start = o
        elif start is not None and not passes:
            out.append(f"\\u{start:04x}-\\u{o - 1:04x}")
            start = None
    return "".join(out)


# letters, numbers, marks and what cannot be seen; one class without categories, which the engine looks up in a table
_W = "[" + _ranges(lambda c: c.isalnum() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Cf"), 0x10000) + "\U00010000-\U0001efff\U00020000-\U0003ffff\U000e0000-\U000e01ef]"
_TOKEN = re.compile(rf"{_W}+(?:[\-\u2010\u2011\u00ad][ \t\r]*\n\s*{_W}+)*")
_PART = re.compile(rf"{_W}+")
_BROKEN = re.compile(r"[\-\u2010\u2011\u00ad][ \t\r]*\n\s*")
_HAN = re.compile(r"[\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def plain_word(raw: str) -> str:
    """One word in the form in which words are compared; marks alone are no word."""
    x = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", raw).casefold())
    if not any(map(str.isalnum, x)):
        return ""
    return "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in x if c.isalnum() or unicodedata.category(c)[0] == "M")


def _plain_letter(c: str) -> str:
    x = unicodedata.normalize("NFKD", c).casefold()
    return "".join(str(unicodedata.decimal(k)) if k.isdecimal() else k for k in x if k.isalnum())


class _Letters(dict):
    def __missing__(self, c: str) -> str:
        self[c] = x = _plain_letter(c)
        return x


class _Words(dict):
    """Raw word to its number in the items, UNKNOWN if none has it, NOTHING if nothing of it is compared; emptied when too large."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, raw: str) -> int:
        if len(self) > 300_000:
            self.clear()
        plain = plain_word(raw)
        self[raw] = x = self.known.get(plain, UNKNOWN) if plain else NOTHING
        return x


def words(text: str, number) -> tuple[list[int], list[int], list[int]]:
    """Numbers, starts and ends of the words of a text. A word broken over a line end counts as one if the whole is known."""
    ids, starts, ends = [], [], []
    for m in _TOKEN.finditer(text):
        raw, at, end = m.group(), m.start(), m.end()
        k = number(_BROKEN.sub("", raw) if "\n" in raw else raw)
        if k < 0 and "\n" in raw:
            for p in _PART.finditer(raw):
                if (k := number(p.group())) != NOTHING:
                    ids.append(k)
                    starts.append(at + p.start())
                    ends.append(at + p.end())
        elif k != NOTHING:
            ids.append(k)
            starts.append(at)
            ends.append(end)
    return ids, starts, ends


def letters(text: str, of: _Letters) -> tuple[str, list[int]]:
    """The compared letters of a text and the place of each in it."""
    out, at = [], []
    for i, c in enumerate(text):
        for k in of[c]:
            out.append(k)
            at.append(i)
    return "".join(out), at


class Automaton:
    """Suffix automaton of several sequences; every state has the set of sequences that hold its strings, as bits."""

    def __init__(self, sequences: list[list], minimum: int):
        self.minimum = minimum
        nxt, link, length, bits = [{}], [-1], [0], [0]

        def extend(last: int, c, mark: int) -> int:
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            bits.append(mark)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    bits.append(0)
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            return cur

        last = 0
        for i, seq in enumerate(sequences):
            for c in seq:
                last = extend(last, c, 1 << i)
            last = extend(last, ("end", i), 0)  # no text holds it, so no match spans two sequences
        for v in sorted(range(1, len(nxt)), key=length.__getitem__, reverse=True):
            if link[v] > 0:
                bits[link[v]] |= bits[v]
        self.next, self.link, self.length, self.bits = nxt, link, length, bits

    def runs(self, units) -> dict[int, list[tuple[int, int]]]:
        """By sequence: the (first unit, one past the last) of the text's longest runs at each end, of at least the minimum."""
        nxt, link, length, bits, least = self.next, self.link, self.length, self.bits, self.minimum
        found: dict[int, dict[int, int]] = {}
        v = n = 0
        for i, c in enumerate(units):
            to = nxt[v].get(c)
            while to is None and v:
                v = link[v]
                n = length[v]
                to = nxt[v].get(c)
            if to is None:
                continue
            v, n = to, n + 1
            if n >= least:
                u, m, seen = v, n, 0
                while m >= least:
                    new = bits[u] & ~seen
                    seen |= new
                    while new:
                        low = new & -new
                        starts = found.setdefault(low.bit_length() - 1, {})
                        starts[i + 1 - m] = i + 1  # a longer run from the same start replaces the shorter one
                        new ^= low
                    u = link[u]
                    m = length[u]
        return {k: [(a, b) for a, b in s.items()] for k, s in found.items()}


class Grams:
    """Fingerprints of all runs of the minimum length, with the blocks they stand in."""

    def __init__(self, blocks: list[list[np.ndarray]], minimum: int):
        self.minimum = minimum
        pairs = [(self.of(seq), i) for i, seqs in enumerate(blocks) for seq in seqs]
        h = np.concatenate([x for x, _ in pairs]) if pairs else np.empty(0, np.uint64)
        at = np.repeat(np.array([i for _, i in pairs], np.int64), [len(x) for x, _ in pairs]) if pairs else np.empty(0, np.int64)
        order = np.lexsort((at, h))
        h, at = h[order], at[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
        h, self.block = h[new], at[new].astype(np.int32)
        self.h, self.first = np.unique(h, return_index=True)
        self.first = np.append(self.first, len(h))

    def of(self, units: np.ndarray) -> np.ndarray:
        n = len(units) - self.minimum + 1
        out = np.zeros(max(n, 0), np.uint64)
        for k in range(self.minimum if n > 0 else 0):
            out = out * np.uint64(0x9E3779B97F4A7C15) + (units[k : k + n] + np.uint64(1))
        return out ^ (out >> np.uint64(29))

    def blocks_of(self, units: np.ndarray) -> list[int]:
        """The blocks that share a run of the minimum with these units; one that does not is named only by a false fingerprint."""
        if not len(self.h):
            return []
        x = self.of(units)
        at = np.minimum(np.searchsorted(self.h, x), len(self.h) - 1)
        hits = np.unique(at[self.h[at] == x])
        return sorted({int(b) for j in hits for b in self.block[self.first[j] : self.first[j + 1]]})


def _units(seq) -> np.ndarray:
    return np.frombuffer(seq.encode("utf-32-le"), np.uint32).astype(np.uint64) if isinstance(seq, str) else np.array(seq, np.int64).astype(np.uint64)


def build(blocks: list[list[tuple[int, str, str]]], min_words: int, min_letters: int) -> dict:
    """What tasks need of blocks of (id, lang, text) items: their units and fingerprints; automata are built from them on demand.

    ``least`` is the fewest Han characters in any run of the minimum of letters.
    """
    known: dict[str, int] = {}
    of = _Letters()
    seqs: dict[str, list[list]] = {"words": [], "letters": []}
    ids: dict[str, list[list[int]]] = {"words": [], "letters": []}
    least = 1 << 30
    for block in blocks:
        by_word = [(i, t) for i, lang, t in block if not lang.startswith(LETTERWISE)]
        by_letter = [(i, t) for i, lang, t in block if lang.startswith(LETTERWISE)]
        seqs["words"].append([[known.setdefault(w, len(known)) for m in _TOKEN.finditer(t) if (w := plain_word(_BROKEN.sub("", m.group())))] for _, t in by_word])
        seqs["letters"].append([letters(t, of)[0] for _, t in by_letter])
        ids["words"].append([i for i, _ in by_word])
        ids["letters"].append([i for i, _ in by_letter])
        for t in seqs["letters"][-1]:
            least = min([least, *(len(_HAN.findall(t[k : k + min_letters])) for k in range(len(t) - min_letters + 1))])
    least_units = {"words": min_words, "letters": min_letters}
    grams = {k: Grams([[_units(x) for x in b] for b in v], least_units[k]) for k, v in seqs.items()}
    return {"known": known, "seqs": seqs, "ids": ids, "grams": grams, "least": least}


def _blocks(items: list, size: int) -> list[list]:
    out, n = [[]], 0
    for x in items:
        if n and n + len(x[2]) > size:
            out.append([])
            n = 0
        out[-1].append(x)
        n += len(x[2])
    return out


class Finder:
    """All shared runs of a text; holds the automata it used last."""

    def __init__(self, a: dict):
        self.a = a
        self.number, self.of = _Words(a["known"]).__getitem__, _Letters()
        self.full = b"\1" * a["grams"]["words"].minimum
        self.held: dict[tuple[str, int], Automaton] = {}

    def _automaton(self, kind: str, block: int) -> Automaton:
        x = self.held.pop((kind, block), None)
        if x is None:
            while len(self.held) >= HELD:
                del self.held[next(iter(self.held))]
            x = Automaton([list(s) for s in self.a["seqs"][kind][block]], self.a["grams"][kind].minimum)
        self.held[kind, block] = x
        return x

    def _runs(self, kind: str, units) -> Iterator[tuple[int, int, int]]:
        for block in self.a["grams"][kind].blocks_of(_units(units)):
            for k, spans in self._automaton(kind, block).runs(units).items():
                yield from ((self.a["ids"][kind][block][k], p, q) for p, q in spans)

    def found(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, units, start, end) of every shared run of a text."""
        out = []
        # whether enough known words follow each other needs no places; words broken over line ends are only settled with them
        if _BROKEN.search(text) or self.full in bytes([k != UNKNOWN for k in map(self.number, _TOKEN.findall(text)) if k != NOTHING]):
            ids, starts, ends = words(text, self.number)
            out += [(i, q - p, starts[p], ends[q - 1]) for i, p, q in self._runs("words", ids)]
        if len(_HAN.findall(text)) >= self.a["least"]:
            flat, at = letters(text, self.of)
            out += [(i, q - p, at[p], at[q - 1] + 1) for i, p, q in self._runs("letters", flat)]
        return out


def _scan(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(shared.value)
        for b in batches:
            rows = [(doc, *r) for doc, text in zip(b["doc"], b["text"], strict=True) if text for r in finder.found(text)]
            yield pd.DataFrame(rows, columns=["doc", "item", "units", "start_pos", "end_pos"])

    return run


def cut(text: str, spans: set[tuple[int, int]], max_share: float) -> tuple[int, int, str | None, bool]:
    """(spans, removed, clean, dropped): a text without its spans; overlapping ones count once."""
    out, at, gone = [], 0, 0
    for start, end in sorted(spans):
        start, end = max(start, at), max(end, at)
        out.append(text[at:start])
        gone += end - start
        at = end
    drop = gone > len(text) * max_share
    return len(spans), gone, None if drop else "".join(out) + text[at:], drop


def _scrub(shared, max_share: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(shared.value)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc"], b["text"], strict=True):
                if text and (spans := {r[2:] for r in finder.found(text)}):
                    rows.append((doc, *cut(text, spans, max_share)))
            yield pd.DataFrame(rows, columns=["doc", "runs", "removed", "clean", "dropped"])

    return run


def _passes(items: DataFrame, item: str, lang: str, text: str, min_words: int, min_letters: int) -> Iterator[dict]:
    """The items, in the order of their ids, for one pass over the documents at a time; the driver holds one pass."""
    x = items.select(F.col(item).cast("bigint").alias("i"), F.lower(F.coalesce(F.col(lang), F.lit(""))).alias("l"), F.col(text).alias("t")).where("t is not null")
    rows, n = [], 0
    for r in x.orderBy("i", "l", "t").toLocalIterator():
        if n and n + len(r.t) > MAX_SCAN:
            yield build(_blocks(rows, MAX_UNITS), min_words, min_letters)
            rows, n = [], 0
        rows.append(tuple(r))
        n += len(r.t)
    yield build(_blocks(rows, MAX_UNITS), min_words, min_letters)


def _input(docs: DataFrame, doc: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("text is not null and text <> ''")


def _runs(docs: DataFrame, doc: str, text: str, passes: list) -> DataFrame:
    kind = docs.schema[doc].dataType.simpleString()
    out = None
    for shared in passes:
        x = _input(docs, doc, text).mapInPandas(_scan(shared), f"doc {kind}, item bigint, units int, start_pos int, end_pos int")
        out = x if out is None else out.unionByName(x)
    return out


def shared_runs(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, lang: str, item_text: str, min_words: int = MIN_WORDS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(doc, item, units, start_pos, end_pos): the shared runs of every document with every item, with code point offsets.

    Null and empty texts share nothing; repeated documents and items each give their own rows; items shorter than the minimum
    cannot be found. Whole texts are read, in one pass per MAX_SCAN characters of items and without a shuffle.
    """
    passes = [docs.sparkSession.sparkContext.broadcast(a) for a in _passes(items, item, lang, item_text, min_words, min_letters)]
    return _runs(docs, doc, text, passes).withColumnsRenamed({"doc": doc, "item": item})


def leaks(*args, **kwargs) -> DataFrame:
    """(doc, item), each once."""
    x = shared_runs(*args, **kwargs)
    return x.select(x.columns[:2]).distinct()


def scrubbed(docs: DataFrame, doc: str, text: str, items: DataFrame, item: str, lang: str, item_text: str, max_share: float = 0.5, min_words: int = MIN_WORDS, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(doc, runs, removed, clean, dropped): documents with leaks, their leaked spans taken out.

    ``removed`` counts code points; overlapping spans count once. A document of which more than ``max_share`` leaked is dropped:
    its clean text is null. Cutting is part of the one pass over the documents; only items beyond one pass need a join.
    """
    kind = docs.schema[doc].dataType.simpleString()
    schema = f"doc {kind}, runs int, removed int, clean string, dropped boolean"
    passes = [docs.sparkSession.sparkContext.broadcast(a) for a in _passes(items, item, lang, item_text, min_words, min_letters)]
    if len(passes) == 1:
        return _input(docs, doc, text).mapInPandas(_scrub(passes[0], max_share), schema).withColumnRenamed("doc", doc)
    spans = _runs(docs, doc, text, passes).groupBy("doc").agg(F.collect_set(F.struct("start_pos", "end_pos")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, *cut(t, {(x["start_pos"], x["end_pos"]) for x in s}, max_share)) for d, t, s in zip(b["doc"], b["text"], b["spans"], strict=True)]
            yield pd.DataFrame(rows, columns=["doc", "runs", "removed", "clean", "dropped"])

    return _input(docs, doc, text).join(spans, "doc").mapInPandas(run, schema).withColumnRenamed("doc", doc)

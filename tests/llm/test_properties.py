"""Operators against brute force on random input."""

import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from mentionmill.llm import canonical as M
from mentionmill.llm import confusables as U
from mentionmill.llm import leakage as L
from mentionmill.llm import sentences as S

few = st.text("abc", max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(few, min_size=1, max_size=4), st.text("abcd", max_size=30), st.integers(1, 4))
def test_automaton_finds_just_the_shared_runs(items, text, least):
    got = L.Automaton([list(x) for x in items], least).runs(text)
    for i, x in enumerate(items):
        want = {text[a:b] for a, b in itertools.combinations(range(len(text) + 1), 2) if b - a >= least and text[a:b] in x}
        spans = got.get(i, [])
        assert all(text[a:b] in x and b - a >= least for a, b in spans)
        covered = {k for a, b in spans for k in range(a, b)}
        assert covered == {k for a, b in itertools.combinations(range(len(text) + 1), 2) if b - a >= least and text[a:b] in x for k in range(a, b)}
        assert bool(spans) == bool(want)


@settings(max_examples=200, deadline=None)
@given(st.text("aАéе́​ Ａ-‐ﬁ ß", max_size=12))
def test_canonical_form_is_stable_and_needs_no_context(text):
    once = U.canonical(text)
    assert U.canonical(once) == once
    assert U.canonical(text.replace("​", "")) == once
    assert U.canonical(" " + text + " ") == once


@settings(max_examples=300, deadline=None)
@given(st.text("aB1. ?!\n\"'()[]«»“”„。！”水ไม่พบ-…,:​", max_size=60))
def test_sentences_cover_all_that_is_visible_in_order(text):
    spans = S.split(text)
    at = 0
    for a, b in spans:
        assert at <= a < b and not text[a].isspace() and not text[b - 1].isspace()
        assert not text[at:a].replace("​", "").strip()
        at = b
    assert not text[at:].replace("​", "").replace("﻿", "").replace("⁠", "").strip()


@settings(max_examples=200, deadline=None)
@given(st.text("abe", min_size=1, max_size=7), st.text("abe", min_size=1, max_size=7))
def test_symmetric_deletes_meet_whenever_two_words_are_near(a, b):
    d = M._edits(a, b)
    if d <= 2:
        assert M.deletes(a, 2) & M.deletes(b, 2)
    assert M._edits(a, b) == M._edits(b, a) and (d == 0) == (a == b)
    assert M.distance(a, b) <= d * 1.2 + 1e-9

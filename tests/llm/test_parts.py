"""Methods of the operators on small inputs."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderflow.llm import bpe, chat, decontaminate, jaccard, langid, licenses, packing, warc
from orderflow.llm.common import components
from orderflow.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def counter():
    return bpe.Counter(bpe.read_merges(VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


TRICKY = ["", " ", "don't 's 'LL ''s", "<|endoftext|>a<|startoftext|> x<|ENDOFTEXT|>", "ΑΣ İ ẞ",
          "x" * 3000, "日本語 é ́", "\x1c\x1d1²½ ", "\U0001F600‍!!", "Ɤ ɐ"]


@pytest.mark.parametrize("text", TRICKY)
def test_counts_like_the_library(counter, library, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=40))
def test_ids_like_the_library(text):
    encoder = packing.Encoder.shared = getattr(packing.Encoder, "shared", None) or \
        packing.Encoder(VOCABULARY)
    want = encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def test_words_of_many_texts_are_learned_together(library, monkeypatch):
    """Texts are encoded in few calls, and a full memory gives back the words that come again."""
    texts = [*TRICKY, *(f"word{i} common text, number {i * 7}" for i in range(300))]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for together, remembered, most in ((1 << 19, 400_000, 10), (40, 30, 10_000)):
        monkeypatch.setattr(packing, "TOGETHER", together)
        monkeypatch.setattr(packing, "REMEMBERED", remembered)
        encoder = packing.Encoder(VOCABULARY)
        calls, direct = [], encoder._direct
        encoder._direct = lambda text: calls.append(text) or direct(text)
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_all(texts)]
        assert got == want
        assert len(calls) < most


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_plan_places_every_piece_once(lengths):
    histogram = np.bincount(np.array(lengths, int), minlength=65)
    plan = packing.Plan(histogram, 64)
    length = np.repeat(np.arange(65), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram])
    sequence, offset = plan.place(length, rank)
    ends = {}
    for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), length.tolist())):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert all(e <= 64 for e in ends.values()) and len(ends) == plan.sequences


def test_code_lengths_are_a_distribution():
    text = np.frombuffer(b"the rain in spain stays mainly in the plain " * 20, np.uint8)
    codes = langid.coded(text, np.array([0]))
    model = langid.Model(["x"], [np.unique(codes, return_counts=True)], 2)
    share = np.exp2(-model.bits.reshape(-1, model.size))[:, model.symbol]
    assert share.shape[1] == 256 and np.allclose(share.sum(axis=1), 1, atol=1e-4)
    whole = model.code_lengths(text, np.array([0]))[0, 0]
    parts = model.code_lengths(text, np.array([0, 440])).sum()
    assert whole / len(text) < 2 and abs(parts - whole) < 60


def plain_ppm(counts, least, text):
    """Bits of a text's bytes by the definition; counts: per language Counters by context."""
    total = Counter()
    for language in counts:
        for context, seen in language.items():
            total[context] += sum(seen.values())

    def known(context):
        return total[context] >= (least if len(context) > 1 else 1)

    def shares(language, context):
        if context is None:
            return dict.fromkeys(range(256), 1 / 256)
        lower = shares(language, context[:-1] if context else None)
        if context and not known(context):
            return lower
        seen = language.get(context, Counter())
        rest = sum(p for s, p in lower.items() if s not in seen)
        n, kinds = sum(seen.values()), len(seen) if rest > 0 else 0
        if not n:
            return lower
        return {s: seen[s] / (n + kinds) if s in seen else kinds / (n + kinds) * p / rest
                for s, p in lower.items()}

    for language in counts:
        bits, before = 0.0, (32, 32, 32)
        for symbol in text:
            bits -= math.log2(shares(language, before)[symbol])
            before = (symbol, *before[:2])
        yield bits


def read(text):
    """The bytes that the models read."""
    return [b if b > 127 or chr(b).isalpha() else 32 for b in text.lower()]


@pytest.mark.parametrize("least", [1, 3])
def test_code_lengths_against_the_definition(least):
    texts = [[b"the rain in spain stays mainly in the plain", b"rain again, the same rain"],
             ["les gens de la ville et la pluie".encode(), "été à la ville".encode()]]
    counts, grams = [], []
    for language in texts:
        seen, codes = defaultdict(Counter), []
        for text in language:
            codes.append(langid.coded(np.frombuffer(text, np.uint8), np.array([0])))
            before = (32, 32, 32)
            for symbol in read(text):
                for k in range(4):
                    seen[before[:k]][symbol] += 1
                before = (symbol, *before[:2])
        counts.append(seen)
        grams.append(np.unique(np.concatenate(codes), return_counts=True))
    model = langid.Model(["en", "fr"], grams, least)
    for text in ("the plain rain", "la ville été", "xyz QRS 12", "日本"):
        data = np.frombuffer(text.encode(), np.uint8)
        got = model.code_lengths(data, np.array([0]))[0]
        assert np.allclose(got, list(plain_ppm(counts, least, read(text.encode()))),
                           rtol=1e-5)


def test_code_lengths_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 110, 5000).astype(np.uint8)
    starts = np.array([0, 1, 3, 900, 901, 4000])
    model = langid.Model(["x"], [np.unique(langid.coded(data, starts), return_counts=True)], 1)
    want = model.code_lengths(data, starts)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert np.allclose(model.code_lengths(data, starts), want)


def test_loser_tree_merges_runs():
    random.seed(3)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((("a", i, random.choice("xyz"), str(random.randint(0, 4)),
                         random.choice([None, 1, 2])) for i in range(random.randint(0, 9))),
                       key=warc._order) for _ in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert [warc._order(r) for r in merged] == sorted(warc._order(r) for x in runs for r in x)


def test_url_keys():
    assert warc.url_key("https://www.B.example.com:80/A?q#x") == "com,example,b)/a?q"
    assert warc.url_key("") == ")"


def test_rewritten_history_is_detected():
    def forgetful(turns):  # drops what earlier assistants thought
        last = len(turns) - 1
        return "".join(f"[{r}]{re.sub('<t>.*</t>', '', t) if i < last else t}\n"
                       for i, (r, t) in enumerate(turns))

    turns = [("user", "a"), ("assistant", "<t>hm</t>b"), ("user", "c")]
    _, found = chat.locate(forgetful, turns, str)
    assert [f.rewritten for f in found] == [False, True, False]
    text, found = chat.locate(chat.marked_turns, [("user", "</turn>\n"), ("assistant", "turn")])
    assert [chat.unescape(text[f.text_start:f.text_end]) for f in found] == ["</turn>\n", "turn"]
    assert not any(f.rewritten for f in found)


@given(st.lists(st.tuples(st.text(max_size=6), st.text(max_size=20)), max_size=4))
def test_marked_turns_are_read_back(turns):
    assert list(chat.read_marked(chat.marked_turns(turns))) == turns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=60), st.lists(st.sampled_from("abcde"), max_size=6))
def test_phrases_by_index(text, window):
    text, window = [w.encode() for w in text], tuple(w.encode() for w in window)
    if not window or not text:
        return
    terms = sorted(set(text))
    ids = np.array([terms.index(w) for w in text])
    found = decontaminate.occurrences(
        decontaminate.Block(["i"], [window]), terms, np.bincount(ids, minlength=len(terms)),
        np.argsort(ids, kind="stable").astype(np.int64), 0)
    want = [i for i in range(len(text)) if tuple(text[i:i + len(window)]) == window]
    assert sorted(found[1].tolist()) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("permission is hereby granted free of the mit license".split()),
                max_size=30))
def test_template_join_is_exact(words):
    texts = {"Permission is hereby granted, free of charge": "a", "the MIT License": "b"}
    join = licenses.Templates(texts, 0.8, {b"the": 9, b"of": 7, b"is": 3})
    block = {w.encode() for w in words}
    want = [(t, len(s & block) / len(s)) for t, s in enumerate(join.sets)
            if len(s & block) >= 0.8 * len(s) - 1e-9]
    assert sorted(join.match(block)) == want


def test_components(make):
    rows = [(i, i + 1) for i in range(1, 40)] + [(50, 51), (52, 51), (60, 60)]
    out = {r.node: r.root for r in components(make("a long, b long", *rows)).collect()}
    assert out == {**{i: 1 for i in range(1, 41)}, 50: 50, 51: 50, 52: 50}
    assert components(make("a long, b long")).collect() == []


def test_shingles():
    assert len(jaccard.shingle_hashes(b"a b c", 4)) == 1
    assert len(jaccard.shingle_hashes(None, 4)) == 0
    assert len(np.unique(jaccard.shingle_hashes(b"A b c d A b c d a", 4))) == 4

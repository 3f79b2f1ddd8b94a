"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import datetime
import hashlib
import random
import string
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from checks.compare import differences
from orderflow.llm import (
    bpe, chat, decontaminate, exact_dedup, jaccard, langid, licenses, packing, secrets, warc,
)
from orderflow.llm.common import ROW_KEY, _plain, keyed, prepare
from orderflow.llm.oracles import ORACLES
from orderflow.llm.queries import VOCABULARY

EMPTY = hashlib.sha256(b"").hexdigest()
DDL = ("doc_id long, text string, lang string, source string, n_chars long, row string, "
       "n long, `group` string, print string, token int, home string, hash int, salt int")
ITEMS = "item_id long, text string, words string"
PASSAGE = "one two three four five six seven eight nine ten"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "Hello world, again and again"), (None, "a b"),
             (4, "Hello world, again and again"), (5, "Hello  world, again and again"),
             (6, long), (7, "123 456"), (None, None), (8, f"so {PASSAGE} it is"),
             (9, "password = abcd1234efgh"), (10, "the MIT License")]
    extra = ("x", 1, "y", "z", 3, "q", 4, 5)
    return spark.createDataFrame(
        [(i, t, "en" if t else None, None if i == 9 else "s", None, *extra) for i, t in texts],
        DDL)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_token_counts(docs, none):
    rows = bpe.count_tokens(docs, VOCABULARY).collect()
    assert len(rows) == 13
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows if r.doc_id}
    assert got[1] == got[2] == (0, 0, False) and got[3] == (3, 0, False) and got[6][2]
    assert bpe.count_tokens(none, VOCABULARY).collect() == []


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame([(1, PASSAGE, ""), (2, None, ""), (3, "", ""), (None, "a b", ""),
                                   (1, PASSAGE, ""), (4, "Hello, WORLD", "")], ITEMS)
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == 13
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert (got[8].n_hit, got[8].n_items, got[8].contaminated) == (10, 1, True)
    assert got[8].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert got[4].n_hit == 2 and got[1].n_words == 0 and got[1].items_sha256 == EMPTY
    lone = next(r for r in rows if r.doc_id is None and r.n_words)
    assert (lone.n_hit, lone.n_items, lone.contaminated) == (2, 0, True)
    assert not any(r.contaminated for r in
                   decontaminate.contamination(docs, items.limit(0)).collect())
    assert decontaminate.contamination(none, items).collect() == []
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == 13 - 5


def test_near_matches(make):
    prepare(make("a int").sparkSession)
    words = PASSAGE.split()
    near = " ".join([*words[:5], "extra", *words[5:]])
    docs = make("doc_id long, text string", (1, near), (2, PASSAGE), (3, "nine ten"))
    items = make("item_id long, text string", (7, PASSAGE))
    got = by_id(decontaminate.contamination(docs, items, slop=2))
    assert (got[1].n_hit, got[1].n_near_items) == (0, 1)
    assert (got[2].n_hit, got[2].n_near_items, got[3].n_near_items) == (10, 0, 0)


def near_items(text, items, length, slop):
    """Ids of the items that match exactly, and of those that match nearly, by the definition."""
    text, exact, near = (text or "").split(), set(), set()
    for item, passage in items:
        found = (passage or "").split()
        size = min(length, len(found))
        for window in ([found[i:i + size] for i in range(len(found) - size + 1)] if size else []):
            for at in range(len(text)):
                if text[at:at + size] == window:
                    exact.add(item)
                if text[at] == window[0] and all(
                        w in text[max(0, at + k - slop):at + k + slop + 1]
                        for k, w in enumerate(window[1:], 1)):
                    near.add(item)
    return exact, near - exact


def test_near_matches_by_brute_force(make, monkeypatch):
    prepare(make("a int").sparkSession)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 60)
    monkeypatch.setattr(decontaminate, "CANDIDATES", 7)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 9)
    rng = random.Random(4)

    def some(n):
        return " ".join(rng.choice("abcdefgh") for _ in range(n))

    def changed(text):
        out = text.split()
        for _ in range(rng.randrange(4)):
            out.insert(rng.randrange(1 + len(out)), rng.choice("abcxyz"))
        return " ".join(out)

    items = [(str(i), some(rng.choice([0, 1, 3, 5, 9]))) for i in range(25)] + [("n", None)]
    texts = [(i, f"{some(rng.randrange(8))} {changed(rng.choice(items[:25])[1])} {some(rng.randrange(30))}")
             for i in range(80)] + [(80, None), (81, "")]
    got = by_id(decontaminate.contamination(
        make("doc_id long, text string", *texts), make("item_id string, text string", *items),
        length=5, slop=2))
    want = {i: near_items(t, items, 5, 2) for i, t in texts}
    assert {i: (r.n_items, r.n_near_items) for i, r in got.items()} == {
        i: (len(e), len(n)) for i, (e, n) in want.items()}
    assert sum(len(n) for _, n in want.values()) > 20


def test_windows_in_blocks(make, monkeypatch):
    prepare(make("a int").sparkSession)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 2)
    docs = make("doc_id long, text string", (1, f"{PASSAGE} eleven twelve x {PASSAGE}"))
    items = make("item_id long, text string", (7, f"{PASSAGE} eleven twelve"), (8, PASSAGE))
    got = by_id(decontaminate.contamination(docs, items))
    assert (got[1].n_hit, got[1].n_items) == (22, 2)


def test_language_id(docs, none):
    rows = langid.identify(docs).collect()
    assert len(rows) == 13
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert {got[i].lang_pred for i in (1, 2, 3, 7)} == {"und"} and got[1].score == 0
    assert got[4].lang_pred == "en"
    assert langid.identify(none).collect() == []
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == 8
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def prose(words, i, n=12):
    return " ".join(words[(i * 7 + j * (i % 5 + 1) + j * j) % len(words)] for j in range(n)) + "."


ENGLISH = ("the people of this town have never seen so much rain in a single summer and they went "
           "home before night because nobody would answer when we called about old houses").split()
FRENCH = ("les gens de cette ville ont toujours vu beaucoup de pluie pendant un été et ils sont "
          "rentrés chez eux avant la nuit parce que personne ne voulait répondre").split()


RUSSIAN = ("люди этого города никогда не видели столько дождя за одно лето и вернулись домой до ночи "
           "потому что никто не хотел отвечать когда мы спрашивали о старых домах").split()
UKRAINIAN = ("люди цього міста ніколи не бачили стільки дощу за одне літо і повернулися додому до ночі "
             "тому що ніхто не хотів відповідати коли ми питали про старі будинки").split()
GREEK = ("οι άνθρωποι αυτής της πόλης δεν είδαν ποτέ τόση βροχή ένα καλοκαίρι και γύρισαν σπίτι πριν "
         "νυχτώσει επειδή κανείς δεν ήθελε να απαντήσει για τα παλιά σπίτια").split()


def test_languages_that_are_not_latin(make):
    rows = [(i, prose((RUSSIAN, UKRAINIAN, GREEK)[i % 3], i), ("ru", "uk", "el")[i % 3])
            for i in range(300)]
    docs = make("doc_id long, text string, lang string", *rows)
    prepare(docs.sparkSession)
    want = {i: name for i, _, name in rows}
    held = [r for r in langid.identify(docs).collect() if r.held_out]
    assert len(held) > 30 and all(r.lang_pred == want[r.doc_id] for r in held)


def test_nothing_learned_keeps_texts_with_letters(docs, make):
    unlabelled = docs.selectExpr(*[c for c in docs.columns if c != "lang"],
                                 "cast(null as string) lang").select(docs.columns)
    kept = langid.accepted(unlabelled)
    assert kept.columns == docs.columns and kept.count() == 8
    # every labelled row is held out
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 0]
    tiny = make("doc_id long, text string, lang string",
                *[(i, prose(ENGLISH, i), "en") for i in held], (1, "123", None))
    assert sorted(r.doc_id for r in langid.accepted(tiny).collect()) == held


def test_code_length_rejects_what_is_in_no_learned_language(make):
    rng = random.Random(1)
    noise = "".join(rng.choices(string.ascii_letters, k=400))
    odd = [(-1, noise, None), (-2, "Съешь же ещё этих мягких французских булок, да выпей чаю", None)]
    clean = [(-3, "In this town people never called before summer, and the rain went home.", None),
             (-4, "Les gens sont toujours chez eux pendant la nuit, et personne ne répond.", None),
             (-5, "ok", "en"), (-6, "Rain?", None)]
    learned = [(i, prose(w, i), lang) for i in range(0, 600, 2)
               for i, w, lang in ((i, ENGLISH, "en"), (i + 1, FRENCH, "fr"))]
    ddl = "doc_id long, text string, lang string"
    # the decision is the same however many rows a language was learned from
    for size in (600, 172, 40):
        some = [r for r in learned if r[0] < size]
        kept = langid.accepted(make(ddl, *odd, *clean, *some)).collect()
        assert sorted(r.doc_id for r in kept) == sorted(r[0] for r in [*clean, *some]), size


#: Foreign prose, long enough to tell: a few words cost too little to be judged.
FOREIGN = ("Съешь же ещё этих мягких французских булок, да выпей чаю, и снова повтори это",
           "我们昨天在城里看到很多人,他们说今年夏天的雨比往年都要多,所以大家都留在家里",
           "Zażółć gęślą jaźń, a potem wróć do domu, bo nikt nie czeka na ciebie przy bramie. Wszyscy "
           "ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
           "Quel ramo del lago di Como, che volge a mezzogiorno, tra due catene non interrotte di "
           "monti, tutto a seni e a golfi, a seconda dello sporgere e del rientrare di quelli, vien "
           "quasi a un tratto a ristringersi, e a prender corso e figura di fiume, tra un promontorio "
           "a destra, e un'ampia costiera dall'altra parte",
           "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan yhdessä")


def test_foreign_texts_get_the_same_decision_at_every_size(spark):
    got = []
    for size in ("sf0.001", "sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select(
            "doc_id", "text", "lang")
        more = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(FOREIGN)], docs.schema)
        kept = langid.accepted(docs.union(more))
        got.append({r.doc_id for r in kept.where("doc_id < 0").select("doc_id").collect()})
        assert kept.where("doc_id >= 0").count() == docs.count()
    assert got[0] == got[1] == got[2] == set()


def test_every_row_is_learned_and_measured(make, monkeypatch):
    """However many rows a language has, none is left out of the counts and of the limit."""
    said = [(i, f"common words {i % 7}", "en") for i in range(9000)]
    docs = make("doc_id long, text string, lang string", *said)
    learned = [r for r in said if zlib.crc32(str(r[0]).encode()) % 5]
    seen = {}
    build, limit = langid.Model.__init__, langid.limit
    monkeypatch.setattr(langid, "HELD", 10)
    monkeypatch.setattr(langid.Model, "__init__", lambda model, names, grams, least: seen.update(
        bytes=sum(int(n.sum()) for _, n in grams)) or build(model, names, grams, least))
    monkeypatch.setattr(langid, "limit", lambda rows, *rest: seen.update(
        rows=rows.count()) or limit(rows, *rest))
    assert langid.accepted(docs).count() == 9000
    assert seen == {"bytes": sum(len(r[1]) for r in learned), "rows": len(learned)}


def test_a_table_keeps_the_commonest_contexts(monkeypatch):
    data = np.frombuffer(b"the cat and the dog and the rat" * 9 + b"qx jz wv", np.uint8)
    grams = [np.unique(langid.coded(data, np.array([0])), return_counts=True)]
    whole = langid.Model(["x"], grams, 1)
    monkeypatch.setattr(langid, "TABLE_BYTES", whole.bits.nbytes // 2)
    half = langid.Model(["x"], grams, 1)
    assert half.bits.nbytes <= langid.TABLE_BYTES
    lengths = [m.code_lengths(data, np.array([0]))[0, 0] for m in (whole, half)]
    assert lengths[0] < lengths[1] < len(data)


@pytest.mark.parametrize("kind", ["string", "struct<file_path: string, row_index: bigint>"])
def test_tables_with_a_column_of_the_hidden_name(spark, tmp_path, kind):
    """A column ``_metadata`` is data like any other: rows stay apart, and keep it."""
    value = ("named_struct('file_path', 'f', 'row_index', 0L)" if kind != "string" else "'m'")
    df = spark.range(6).selectExpr("id AS doc_id", "CAST(id % 2 AS STRING) AS text", "'s' AS source",
                                   f"{value} AS _metadata", "concat('http://a/', id) AS url",
                                   "id AS page_id", "CAST(id AS STRING) AS html")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for rows in (stored, df, stored.where("doc_id < 100"), stored.repartition(3)):
        assert keyed(rows).select(*ROW_KEY).distinct().count() == 6
        kept = exact_dedup.distinct_texts(rows)
        assert kept.columns == rows.columns and kept.count() == 2
        assert kept.select("_metadata").distinct().count() == 1
    assert jaccard.one_per_group(stored).count() == 2
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.clean(stored, none).count() == 6
    assert secrets.scan(stored).count() == 6
    assert warc.archive_captures(stored).count() == 6


def test_jaccard(docs, none):
    rows = jaccard.similar_documents(docs).collect()
    assert len(rows) == 13 and sum(r.first for r in rows) == 11
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert got[4].component_id == got[5].component_id == 4 and got[1].n_shingles == 0
    assert all(r.component_id == r.doc_id for r in rows if r.n_shingles == 0)
    assert jaccard.similar_documents(none).collect() == []
    kept = jaccard.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == 11


def test_jaccard_with_split_groups(make, monkeypatch):
    """Chains of near copies in many small groups, against brute force."""
    prepare(make("a int").sparkSession)
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 150)
    monkeypatch.setattr(jaccard, "GROUP_SETS", 2)
    monkeypatch.setattr(jaccard, "QUERY_SHINGLES", 400)
    texts = []
    for i in range(40):
        base = [f"t{j}" for j in range(i % 3 * 100, i % 3 * 100 + 60)]
        base[:i // 2] = [f"new{i % 3}x{j}" for j in range(i // 2)]
        texts.append((i, " ".join(base)))
    got = {r.doc_id: r.component_id for r in
           jaccard.similar_documents(make("doc_id long, text string", *texts)).collect()}
    sets = [{tuple(t.split()[k:k + 4]) for k in range(57)} for _, t in texts]
    root = list(range(40))
    for _ in range(40):
        for a in range(40):
            for b in range(40):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == dict(enumerate(root)) and 1 < len(set(root)) < 40


def test_chat(make):
    prepare(make("a int").sparkSession)
    rows = [(1, 2, "assistant", None, "x"), (1, 1, "user", "hi", "x"), (1, 1, "user", "hi", "x"),
            (None, None, None, "\\l<b>", "x"), (2, 0, "a>\n<", "t", "x")]
    rows += [(3, i, "assistant", f"a{i}", "x") for i in range(100)]
    df = make("conv_id long, turn long, role string, text string, place string", *rows)
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == 0 and got[1].loss_sha256 == EMPTY
    assert got[None].turns_sha256 == hashlib.sha256(b"\n\\l<b>\n").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"a>\n<\nt\n").hexdigest()
    text = "".join(f"a{i}" for i in range(100)).encode()
    assert (got[3].n_turns, got[3].loss_sha256) == (100, hashlib.sha256(text).hexdigest())
    assert chat.format_conversations(df.limit(0)).collect() == []


def begin_mark(turns):
    return "<s>" + "".join(f"[{r}]{t}\n" for r, t in turns)


def first_header(turns):
    return "".join(f"{'system ' if i == 0 else ''}[{r}]{t}\n" for i, (r, t) in enumerate(turns))


def numbered(turns):
    return "".join(f"{i}[{r}]{t}\n" for i, (r, t) in enumerate(turns))


def forgetful(turns):
    last = len(turns) - 1
    return "".join(f"[{r}]{t if i == last else t.replace('hm ', '')}\n"
                   for i, (r, t) in enumerate(turns))


@pytest.mark.parametrize("template", [begin_mark, first_header, numbered, forgetful])
def test_templates_see_the_whole_conversation(make, template):
    prepare(make("a int").sparkSession)
    sizes = {1: 45, **dict.fromkeys(range(2, 40), 3), 40: 17}
    turns = {c: [("user" if i % 2 else "assistant", f"hm {c} says {i}") for i in range(n)]
             for c, n in sizes.items()}
    df = make("conv_id long, turn long, role string, text string",
              *[(c, i, *t) for c, all_turns in turns.items() for i, t in enumerate(all_turns)])
    blocks = sorted(chat.render(df, template, str).collect(), key=lambda r: r.place)
    for c, all_turns in turns.items():
        mine = [r for r in blocks if r.conv_id == c]
        assert "".join(r.formatted for r in mine) == template(all_turns)
        changed = [x for r in mine for x in r.rewritten]
        assert changed == [template is forgetful] * (len(all_turns) - 1) + [False]
        if template is not forgetful:
            assert [r.formatted[a:b] for r in mine for a, b in zip(r.starts, r.ends, strict=True)
                    ] == [t for _, t in all_turns]


def test_concatenative_templates_are_split(make):
    rows = [(1, i, "user", f"t{i}") for i in range(100)]
    df = make("conv_id long, turn long, role string, text string", *rows)
    blocks = sorted(chat.render(df).collect(), key=lambda r: r.place)
    assert max(len(r.roles) for r in blocks) <= chat.BLOCK_TURNS and len(blocks) >= 7
    assert "".join(r.formatted for r in blocks) == chat.marked_turns([r[2:] for r in rows])


def test_licenses(docs, none):
    rows = licenses.scan(docs).collect()
    assert len(rows) == 13
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert (got[10].n_base, got[10].first_word, got[10].last_word) == (1, 1, 1)
    assert (got[1].n_words, got[1].first_word, got[1].labels, got[1].score) == (0, None, "", 0)
    assert licenses.scan(none).collect() == []


def wrap(template, width, prefix=""):
    return "\n".join(prefix + line for line in textwrap.wrap(template, width))


def test_wrapped_notices(make):
    before, after = "import os\n\n", "\n\nx = 1\n"
    rows, want = [], {}
    for template, label in licenses.TEMPLATES.items():
        for width in (20, 40, 70):
            for prefix in ("", "# ", " * ", "// ", "rem "):
                for words in (0, 1, 63, 200):
                    at = len(rows)
                    filler = wrap("some other words of a text " * words, 60) + "\n"
                    rows.append((at, before + filler + wrap(template, width, prefix) + after))
                    want[at] = label
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."
    rows += [(-1, mpl), (-2, "released to a few\n" + "of us and others " * 5 + "\nunder the\n"
                         + "same old and new " * 9 + "\nlicense"), (-3, None), (-4, "\n\n")]
    got = by_id(licenses.scan(make("doc_id long, text string", *rows)))
    assert {i: got[i].labels for i in want} == want
    assert {got[i].score for i in want} == {1.0}
    assert got[-1].labels == "mpl" and [(b.first, b.last) for b in got[-1].blocks] == [(0, 16)]
    assert {got[i].labels for i in (-2, -3, -4)} == {""}


def test_wrapped_notices_against_sql(make):
    rng = random.Random(8)
    notices = [t.split() for t in licenses.TEMPLATES]
    rows = []
    for i in range(300):
        words = list(rng.choice(notices))
        if i % 3:  # words lost, strange ones between, words of another notice
            words = [w for w in words if rng.random() > 0.15]
            for _ in range(rng.randrange(1 + len(words))):
                words.insert(rng.randrange(1 + len(words)), rng.choice(["x", "rem", *notices[i % 15]]))
        around = [rng.choice(["of", "the", "y", "license"]) for _ in range(rng.choice([0, 5, 150, 700]))]
        line = " ".join(around + words + around[:40])
        rows.append((i, "\n".join(textwrap.wrap(line, rng.choice([15, 50, 4000])))))
    rows += [(300, None), (301, ""), (302, "\n")]
    documents = make("doc_id long, text string", *rows)
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": [i for i, _ in rows],
                                               "text": [t for _, t in rows]}))
    got = licenses.scan(documents).drop("blocks")
    assert differences(got, connection, ORACLES["op6_license_scan"]) == []
    labels = [r.labels for r in got.collect()]
    assert len(set(labels)) > 8 and "" in labels


def test_packing(docs, none):
    rows = packing.pack(docs, VOCABULARY).collect()
    assert len({(r.doc_id, r.start) for r in rows if r.doc_id == 6}) > 1
    assert [(r.doc_tokens, r.length) for r in rows if r.doc_id == 1] == [(1, 1)]
    assert len([r for r in rows if r.doc_id == 4]) == 2
    assert packing.pack(none, VOCABULARY).collect() == []


def test_exact_duplicates(docs, none):
    rows = exact_dedup.duplicate_groups(docs).collect()
    assert len(rows) == 13 and sum(r.kept for r in rows) == 13 - 3 - 2
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert {got[i].keep_id for i in (1, 2, 3)} == {3} and got[1].group_size == 4
    assert got[4].keep_id == 5 and got[4].group_size == 3 and got[1].text_sha256 == EMPTY
    assert exact_dedup.duplicate_groups(none).collect() == []
    kept = exact_dedup.distinct_texts(docs)
    assert kept.columns == docs.columns and kept.count() == 8


def test_pieces_of_a_row_have_keys_of_their_own(spark, make, tmp_path):
    prepare(spark)
    again = "one two three four five six seven"
    rows = make("doc_id long, text string",
                (1, f"{again}|kept alone in the first row|{PASSAGE}"), (2, f"{again}|other piece"))
    rows.coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    pieces = docs.selectExpr("doc_id", "explode(split(text, '[|]')) text")
    texts = {r.text for r in pieces.collect()}
    for left in (exact_dedup.distinct_texts(pieces), jaccard.one_per_group(pieces)):
        assert sorted(r.text for r in left.collect()) == sorted(texts)
    items = make("item_id long, text string", (1, PASSAGE))
    left = decontaminate.clean(pieces, items).collect()
    assert sorted(r.text for r in left) == sorted([*(texts - {PASSAGE}), again])
    for df, plain in ((docs.where("doc_id > 0").selectExpr("doc_id + 1 doc_id", "text"), True),
                      (pieces, False), (docs.where("rand() < 2"), False), (docs.limit(1), False),
                      (docs.distinct(), False)):
        assert _plain(df) == plain
        keys = keyed(df).select(*ROW_KEY)
        assert keys.distinct().count() == keys.count() == df.count()


def test_secrets(docs, none):
    rows = secrets.scan(docs).collect()
    assert len(rows) == 13
    got = {r.doc_id: r for r in rows if r.doc_id}
    assert got[9].spans == "assign:0:23,live:11:23" and (got[9].n_assign, got[9].n_live) == (1, 1)
    assert got[1].spans == "" and got[1].base_sha256 == EMPTY
    assert secrets.scan(none).collect() == []


def test_widely_shown_values_are_examples(make):
    text = "token = abcdef123456 and token = short"
    docs = make("doc_id long, text string, source string",
                *[(i, text, f"s{i % 4}") for i in range(8)])
    rows = secrets.scan(docs).collect()
    assert {(r.spans, r.n_live, r.n_example) for r in rows} == {("assign:0:20", 0, 1)}


def test_different_texts_decide_beside_owners(make):
    common, copied = "token = abcdef123456", "secret = q1w2e3r4t5y6"
    docs = make("doc_id long, text string, source string",
                *[(i, f"{common} of text {i}", "hot") for i in range(6)],
                *[(100 + i, copied, f"s{i}") for i in range(3)],
                (200, "password = z9y8x7w6v5u4", "s0"))
    got = by_id(secrets.scan(docs, most_texts=5, least_texts=2))
    assert {(got[i].n_live, got[i].n_example) for i in range(6)} == {(0, 1)}
    assert {(got[100 + i].n_live, got[100 + i].n_example) for i in range(3)} == {(1, 0)}
    assert (got[200].n_live, got[200].n_example) == (1, 0)
    assert {(s.kind, s.owners, s.texts) for r in got.values() for s in r.shown} == {
        ("assign", 1, 6), ("assign", 3, 1), ("assign", 1, 1)}
    # the defaults: over 100 texts, and copies of one text count their owners
    got = by_id(secrets.scan(docs))
    assert got[0].n_live == 1 and got[100].n_example == 1
    many = make("doc_id long, text string, source string",
                *[(i, f"{common} of text {i}", "hot") for i in range(101)])
    assert {r.n_live for r in secrets.scan(many).collect()} == {0}


def test_warc(make):
    prepare(make("a int").sparkSession)
    page = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\né"
    pages = make("page_id long, url string, html string, digest string, size int",
                 (1, "http://a.b/c", page, "", 0), (2, "http://a.b/c", page, "", 0),
                 (3, None, None, "", 0), (4, "x\r\ny", "", "", 0), (None, "u", "", "", 0),
                 (2, "http://z", page, "", 0))
    rows = warc.archive_captures(pages).collect()
    assert len(rows) == 6 and all(r.intact for r in rows)
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows) == [
        (0, "revisit", 4), (1, "revisit", 2), (2, "response", None), (2, "revisit", 2),
        (3, "revisit", 4), (4, "response", None)]
    placed = sorted(rows, key=lambda r: r.rank)
    assert [r.rank for r in placed] == list(range(6))
    assert [(r.url_key, r.captured) for r in placed] == sorted(
        (r.url_key, r.captured) for r in rows)
    assert warc.archive_captures(pages.limit(0)).collect() == []


def test_capture_history_over_many_ranges(make, monkeypatch, tmp_path):
    spark = make("a int").sparkSession
    prepare(spark)
    monkeypatch.setattr(warc, "FILE_RECORDS", 23)
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    monkeypatch.setattr(warc, "OPEN_ROWS", 3)
    rng = random.Random(5)
    # a third of the captures share a URL; ids repeat and are null
    pages = [(rng.choice([None, rng.randrange(300)]) if rng.random() < 0.1 else i,
              "http://hot.example/a" if rng.random() < 0.34 else f"http://h{i % 50}.example/{i % 7}",
              rng.choice(["", None, f"page {i % 90}"])) for i in range(500)]
    made = make("page_id long, url string, html string", *pages).repartition(5)
    made.write.parquet(str(tmp_path / "pages"))
    rows = warc.archive_captures(spark.read.parquet(str(tmp_path / "pages"))).collect()
    rows.sort(key=lambda r: r.rank)
    assert [r.rank for r in rows] == list(range(500))
    assert len({r.archive for r in rows}) > 20 and all(r.intact for r in rows)
    assert len({(r.archive, r.position) for r in rows}) == 500
    order = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0, r.archive, r.position)
             for r in rows]
    assert order == sorted(order)
    moment = datetime.datetime(1970, 1, 1) + datetime.timedelta(seconds=10 ** 9)
    want = sorted((warc.url_key(u), (moment + datetime.timedelta(seconds=i or 0)).isoformat() + "Z",
                   i or 0) for i, u, _ in pages)
    assert sorted((r.url_key, r.captured, r.page_id or 0) for r in rows) == want


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
        left.write.parquet(str(tmp_path / name.replace(" ", "_")))
        left = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 5, 6, 9, 10]
    last = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
    assert {r.doc_id for r in last.collect()} == {None, 5, 6, 9, 10}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0

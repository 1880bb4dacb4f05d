"""The ten operators and the pipeline against brute force, round trips and held-out labels."""

from __future__ import annotations

import collections
import hashlib
import json
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from foretell.llm import bpe, chat, counts, decontaminate, minhash, packing, quality, queries, spotsigs, toxicity, urls
from foretell.llm.common import texts_of

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.VOCABULARY)
ODD = "abcdefgh the of THE ABC éèñßÖüΣσς İ ²³½Ⅷ१ 漢字かな한국 '’\"_-!?.,$%&* 0123456789\n\t\x1c\x1f\x85 😀👍🏽"
# a null, empty and blank text, one word, copies, and a long text
CASES = [None, "", " \n\t", "Word", "a b c", "a b c", "A  B\tC", "x" * 5000, "the " * 3000, "naïve ΑΣ 漢字 <|endoftext|> e\u0301"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(3)
    found = ["".join(pick.choices(ODD, k=pick.randint(0, 80))) for _ in range(3000)]
    return found + [c or "" for c in CASES] + ["he's I'll we've ''s", "<|startoftext|>x<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def cases(spark):
    """Rows with a null id, a repeated row and columns whose names results use too."""
    rows = [(i, t, "en", 7, 1.0) for i, t in enumerate(CASES)] + [(None, "a b c", None, None, None), (4, "a b c", "en", 7, 1.0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_tokens bigint, score double")


def test_encoder_counter_and_decoder_equal_the_library(library, odd_texts, monkeypatch):
    encoder, decoder, counter = bpe.encoder(PATH), bpe.decoder(PATH), counts.transducer(PATH)
    monkeypatch.setattr(counts, "CHUNK", 7)
    for text, want in zip(odd_texts, library.encode_batch(odd_texts, add_special_tokens=False)):
        ids = encoder.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want.ids
        assert counter.total(text) == len(want.ids)
        assert decoder.decode(ids).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_counts_and_round_trip_of_cases(cases, library):
    got = counts.token_counts(cases, PATH, limit=2).collect()
    assert len(got) == len(CASES) + 2 and sum(r.doc_id is None for r in got) == 1
    both = {r.doc_id: r for r in bpe.round_trip(cases, PATH).collect()}
    for r in got:
        if r.doc_id is not None:
            text = CASES[r.doc_id] or ""
            ids = library.encode(text, add_special_tokens=False).ids
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), len(ids), len(ids) > 2)
            assert both[r.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    ids = bpe.encode(cases, PATH)
    assert ids.count() == len(got)
    assert bpe.decode(ids, PATH).where("text is null").count() == 0


def test_best_fit_finds_the_least_room():
    rows = packing.best_fit([6, 5, 4, 3, 2, 2, 10, 1], 10)
    assert sorted(i for row in rows for i in row) == list(range(8))
    assert len(rows) == 4 and rows[0] == [6]
    pick = random.Random(1)
    lengths = [pick.randint(1, 64) for _ in range(2000)]
    rows = packing.best_fit(lengths, 64)
    assert all(sum(lengths[i] for i in row) <= 64 for row in rows)
    assert len(rows) <= 1.02 * sum(lengths) / 64 + 1


def test_packed_rows_give_back_every_document(cases, library):
    rows = packing.pack(cases, PATH, row_length=64, eos=9, pad=0, window=256).collect()
    found = collections.defaultdict(list)
    for row in rows:
        assert row.position_resets == row.cu_seqlens[:-1] and row.cu_seqlens[-1] == row.n_tokens
        assert packing.position_ids(64, row)[row.cu_seqlens[:-1]].sum() == 0
        for doc, start, ids in packing.read_rows(64, row):
            found[doc].append((start, ids.tolist()))
    for doc, text in enumerate(CASES):
        want = library.encode(text or "", add_special_tokens=False).ids + [9]
        times = 2 if doc == 4 else 1
        got = [i for _, ids in sorted(found[doc]) for i in ids]
        assert sorted(got) == sorted(want * times) and (times == 2 or got == want)
    assert len({(r.shard, r.row) for r in rows}) == len(rows)


def _encoded(encoder, texts):
    ids, cuts = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


def test_packing_makes_the_ids_of_the_library(library, odd_texts, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5000)
    monkeypatch.setattr(packing, "CHARACTERS", 300)
    encoder, pick = packing.LibraryEncoder(PATH), random.Random(7)
    assert encoder.by_words
    plain = "abcXYZ stremvlSTREMVLd ''' éÉßŸÿıſŉ×÷İ 12 .,!_<|> \n\t\r\x0b\x0c"
    texts = odd_texts + ["".join(pick.choices(plain, k=pick.randint(0, 60))) for _ in range(5000)]
    texts += ["x'<|endoftext|>'S", "y" * 12_000 + " z", "'S'Ll''re", "a\x00b c", "<|endoftext|><|endoftext|>"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for step in (len(texts), 97):
        assert [i for n in range(0, len(texts), step) for i in _encoded(encoder, texts[n : n + step])] == want
    assert _encoded(encoder, []) == [] and _encoded(encoder, ["", " \n"]) == [[], []]
    ids, cuts = encoder.encode(pa.array(["none", "a b", "", "c's"]).slice(1, 3))
    assert ids.tolist() == library.encode("a b c's").ids and cuts.tolist() == [0, 2, 2, 4]


def test_packing_with_a_vocabulary_of_other_rules(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\d+|[^\s\d]+"
    (tmp_path / "other.json").write_text(json.dumps(spec))
    encoder, other = (make(str(tmp_path / "other.json")) for make in (packing.LibraryEncoder, Tokenizer.from_file))
    texts = ["It's 1234 o'clock, isn't it?", "", "naïve ΑΣ 漢字 12ab34 <|endoftext|>x"]
    assert not encoder.by_words and _encoded(encoder, texts) == [other.encode(t).ids for t in texts]


def test_packing_asks_the_library_for_a_word_once():
    class Spy:
        def __init__(self, library):
            self.library, self.seen = library, []

        def encode(self, text, **more):
            self.seen += text.split()
            return self.library.encode(text, **more)

        def encode_batch_fast(self, texts, **more):
            self.seen += " ".join(texts).split()
            return self.library.encode_batch_fast(texts, **more)

    encoder = packing.LibraryEncoder(PATH)
    encoder.library = spy = Spy(encoder.library)
    for texts in (["Rain, rain! (RAIN)", "rain's"], ["It's rain, (rain) It's"]):
        _encoded(encoder, texts)
    assert sorted(spy.seen) == sorted(["rain", ",", "!", "(", ")", "'s", "it"])


def _components(texts: dict, width: int, percent: int = 80) -> dict:
    sets = {k: set(minhash.shingle_hashes(t or "", width).tolist()) for k, t in texts.items()}
    root = {k: k for k in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(texts)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((top(a), top(b)))
                    root[q] = p
    return {k: top(k) for k in keys}


def test_near_groups_equal_all_pairs(spark, monkeypatch):
    pick = random.Random(5)
    texts, at = {}, 0
    for size in [4, 5, 6, 8, 12, 20, 40, 150, 400]:
        base = [str(pick.randint(0, 10**9)) for _ in range(size)]
        for _ in range(12):
            words = list(base)
            for _ in range(pick.randint(0, max(1, size // 12))):
                words[pick.randrange(len(words))] = str(pick.randint(0, 10**9))
            texts[at] = " ".join(words)
            at += 1
    # a family that is similar, but mostly not linked, so that blocks are needed
    base = [str(pick.randint(0, 10**9)) for _ in range(120)]
    for _ in range(90):
        words = list(base)
        for _ in range(pick.randint(4, 9)):
            words[pick.randrange(len(words))] = str(pick.randint(0, 10**9))
        texts[at] = " ".join(words)
        at += 1
    monkeypatch.setattr(minhash, "SHORT", 16)
    monkeypatch.setattr(minhash, "BLOCK", 32)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for width in (1, 2):
        got = {r.doc_id: r.component_id for r in minhash.near_groups(df, width).collect()}
        assert got == _components(texts, width)


def _roots(edges: list[tuple[int, int]]) -> dict:
    """The smallest id of each node's component."""
    root = {x: x for edge in edges for x in edge}
    while any(root[a] != root[b] for a, b in edges):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components_take_few_jobs(spark):
    """What a round costs the driver is paid only where a task's own edges leave something open."""
    path = [(i + 1, i) for i in range(300)]
    edges = spark.createDataFrame(path, "a bigint, b bigint").repartition(3)
    context = spark.sparkContext
    context.setJobGroup("components", "components")
    try:
        got = minhash.components(edges)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("components")
    assert 0 < len(jobs) <= 8
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(301)}


@pytest.mark.parametrize("most", [4, 1 << 20])
def test_components_over_many_tasks(spark, monkeypatch, most):
    pick = random.Random(9)
    path = pick.sample(range(-70, 70), 140)
    pairs = list(zip(path[:100], path[1:101])) + [(1000 + i, 1000) for i in range(1, 40)]
    pairs += [(x, y) for x, y in ((pick.randint(2000, 2060), pick.randint(2000, 2060)) for _ in range(45)) if x != y]
    pairs += [(b, a) for a, b in pairs[:30]] + pairs[:30]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(minhash, "EDGES", most)
    try:
        # one task does not see all edges
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        edges = spark.createDataFrame(pairs + [(5000, 5000), (None, 7)], "a bigint, b bigint")
        got = [tuple(r) for r in minhash.components(edges).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
    assert sorted(got) == sorted(_roots(pairs).items())
    assert minhash.components(edges.limit(0)).count() == 0


def test_stars_equal_components():
    pick = random.Random(4)
    for _ in range(200):
        n = pick.randint(1, 40)
        pairs = [(x, y) for x, y in ((pick.randint(-n, n), pick.randint(-n, n)) for _ in range(n)) if x > y]
        u, v = minhash.stars(*(np.array([p[i] for p in pairs], np.int64) for i in (0, 1)))
        assert dict(zip(u.tolist(), v.tolist())) == {x: r for x, r in _roots(pairs).items() if x != r}


def test_near_groups_of_cases(cases):
    got = minhash.near_groups(cases, 2).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(CASES) + 2
    assert [by_id[i].n_shingles for i in range(7)] == [0, 0, 0, 1, 2, 2, 2]
    assert [by_id[i].component_id for i in range(7)] == [0, 1, 2, 3, 4, 4, 4]
    assert by_id[None].component_id is None
    assert minhash.near_groups(cases.limit(0), 2).count() == 0


def test_spots(spark, cases):
    got = {r.doc_id: r for r in spotsigs.edited_fingerprints(cases.where("doc_id is not null")).distinct().collect()}
    assert got[0].fingerprint == got[1].fingerprint == "" and got[4].fingerprint == got[5].fingerprint
    assert got[0].near_next == 1.0 and got[3].near_next == 0.0
    assert spotsigs.edited_fingerprints(cases.limit(0)).count() == 0
    rows = queries.op4_spotsigs(spark, SMALL).collect()
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    by_id = {r.doc_id: r for r in rows}
    for n, (doc, text) in enumerate(docs):
        after = docs[(n + 1) % len(docs)]
        half = len(text) // 2
        assert by_id[doc].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[1][:half]).encode()).hexdigest()
        a, b = set(by_id[doc].fingerprint.split()), set(by_id[after[0]].fingerprint.split())
        assert by_id[doc].near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)


def test_spots_cover_the_whole_text(spark):
    def found(*texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        return [set(r[0]) for r in rows.select("doc_id", spotsigs.spots(F.col("text")).alias("s")).orderBy("doc_id").select("s").collect()]

    words = [f"item{i}x" for i in range(128)]
    other = [f"thing{i}y" for i in range(64)]
    cjk = "".join(chr(0x4E00 + 7 * i) for i in range(100))
    whole, half, head, behind, near, east, east_half = found(
        " ".join(words), " ".join(words[:64] + other), " ".join(words[:4] + other), "the " + " ".join(words),
        " ".join([*words[:50], "more", *words[50:]]), cjk, cjk[:50] + cjk[50:][::-1],
    )
    like = lambda a, b: len(a & b) / len(a | b)
    assert 0.2 < like(whole, half) < 0.5 and like(whole, head) < 0.1
    assert like(whole, near) > 0.8 and like(whole, behind) > 0.7
    assert 0.2 < like(east, east_half) < 0.8
    # any word that changes changes the spots
    changed = found(" ".join(words), *(" ".join([*words[:i], "new", *words[i + 1 :]]) for i in range(0, 128, 9)))
    assert all(changed[0] != c for c in changed[1:])


def test_spot_search_equals_all_pairs(spark):
    docs = texts_of(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text")
    sets = docs.select("doc_id", spotsigs.spots(F.col("text")).alias("spots")).cache()
    got = {(r.query_id, r.doc_id) for r in spotsigs.search(sets.where("doc_id % 5 = 0"), sets, 0.6).collect()}
    all_sets = {r.doc_id: set(r.spots) for r in sets.collect()}
    want = {
        (a, b)
        for a, x in all_sets.items()
        for b, y in all_sets.items()
        if a % 5 == 0 and x and y and len(x & y) >= 0.6 * len(x | y) - 1e-9
    }
    assert got == want


def test_urls(spark):
    rows = [
        (1, "http://A.Example.com/en/1?x#y"), (2, "https://www.example.com/en/2"), (3, "x.net/es/1"), (4, None),
        (5, "http://a.net/es/1"), (6, "http://net/fr/x#/es/"), (7, "http://notexample.com/en/1"), (8, "http://com?/q"),
        (9, "http://a.org:80/p/9"), (9, "http://a.org:80/p/9"), (10, "a://b://c/d"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in urls.judge(df, queries.RULES).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert (got[2].rule, got[2].verdict) == ("www.example.com/en/", "allow")
    assert (got[3].host, got[3].path, got[4].host, got[4].path) == ("", "", "", "")
    assert [got[i].rule for i in (5, 6, 7, 8)] == ["net/es/", "net/fr/", "com/", None]
    assert (got[9].host, got[9].template, got[10].host) == ("a.org:80", "/p/*", "b:")
    assert urls.judge(df, queries.RULES).count() == len(rows)
    assert urls.judge(df.limit(0), queries.RULES).count() == 0


def test_url_templates_learn_from_labels(spark):
    rows = [(i, f"http://s.io/{'bad' if i % 2 else 'good'}/{i}") for i in range(200)] + [(200, "http://s.io/new/1")]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = [("s.io", f"/bad/{n}", "block") for n in (1, 3, 5)] + [("s.io", f"/good/{n}", "allow") for n in (2, 4, 6)]
    got = {r.page_id: r for r in urls.judge(df, rules).collect()}
    assert got[9].template == "/bad/*" and got[9].verdict == "block"
    assert got[8].verdict == "allow" and got[200].verdict == "allow"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op7_quality(spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    held = [d for d in labels if got[d].held_out]
    assert np.mean([got[d].predicted == labels[d] for d in held]) > 0.9


def test_url_templates_below_the_third_segment_and_given_labels(spark):
    kind = lambda i: "bad" if i % 2 else "good"
    rows = [(i, f"http://s.org/a/b/c/{kind(i)}/x/{i}") for i in range(60)] + [(60, "http://s.org/a/q/r/s/t/u"), (61, "http://t.org/a")]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    told = [(f"http://s.org/a/b/c/{kind(i)}/x/{i + 1000}", i % 2) for i in range(60)] + [("http://s.org/a/b/c/good/x/1", None)]
    labelled = spark.createDataFrame(told, "url string, blocked int")
    got = {r.page_id: r for r in urls.judge(df, [], labelled=labelled).collect()}
    assert len(got) == len(rows) and got[1].template == "/a/b/c/bad/x/*" and got[60].template == "/a/q/r/**"
    assert [got[i].verdict for i in (1, 2, 59, 58, 60, 61)] == ["block", "allow", "block", "allow", "allow", "allow"]
    assert all(r.verdict == "allow" for r in urls.judge(df, []).collect())


def test_quality_reads_every_word():
    at = {name: i for i, name in enumerate(quality.FEATURES)}
    for text, capital, marked in (
        ("a B c, d E f. g", 2 / 7, 2 / 7), ("a Bb", 1 / 2, 0), ("A" + " b" * 6, 1 / 7, 0), ("Go, go! Go, é", 2 / 4, 3 / 4), ("", 0, 0), (" ", 0, 0)
    ):
        found = quality.statistics(text)
        assert (found[at["capital_words"]], found[at["marked_words"]]) == pytest.approx((capital, marked))


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [d for d in labels if got[d].held_out]
    hits = sum(got[d].predicted and labels[d] for d in held)
    assert hits >= 0.85 * sum(labels[d] for d in held) and hits >= 0.9 * sum(got[d].predicted for d in held)


def test_classifiers_on_cases(spark, cases):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(cases, labels, F.lit(True)).collect()} == {0.5}
    assert max(r.score for r in toxicity.toxicity_scores(cases, labels, F.lit(True)).collect()) < 1e-9
    some = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")
    assert quality.quality_scores(cases, some, F.lit(True)).count() == cases.count()
    assert toxicity.toxicity_scores(cases, some, F.lit(True)).count() == cases.count()


def test_grammar_modes():
    grammar = toxicity.Grammar(words={"idiot": 2.0})
    modes = lambda text: grammar.clauses(text, grammar.run_symbols)[0]
    assert modes("an idiot here") == [2.0, 0, 0, 0]
    assert modes("you are an idiot. an idiot") == [2.0, 2.0, 0, 0]
    assert modes("you are not an idiot") == [0, 0, 2.0, 0]
    assert modes("she said idiot") == [0, 0, 0, 2.0]


def test_chat_round_trip(spark):
    part = "struct<type string, text string, ref string, width int, height int, seconds double, pages int>"
    text = lambda s: ("text", s, None, None, None, None, None)
    rows = [
        (1, 0, "user", [text("a\\b <|end|>"), ("image", None, "i.png", 56, 29, None, None), text("\\"), ("audio", None, "s", None, None, 2.0, None)]),
        (1, 1, "assistant", [text("<|turn|>x\n\\<|")]),
        (1, 2, None, None),
        (None, 0, "assistant", []),
    ]
    schema = f"conv_id bigint, turn bigint, role string, parts array<{part.replace(' string', ': string').replace(' int', ': int').replace(' double', ': double')}>"
    out = chat.format_conversations(spark.createDataFrame(rows, schema).withColumn("formatted", F.lit(0)))
    got = {r.conv_id: r for r in out.select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    ).collect()}
    turns = got[1].turns
    assert turns[0].text == "a\\b <|end|><|image:0.1|>\\<|audio:0.3|>" and turns[1].text == "<|turn|>x\n\\<|"
    assert got[1].loss == "<|turn|>x\n\\<|" and got[1].n_turns == 3
    assert [(a.slot, a.type, a.ref, a.tokens) for a in got[1].attachments] == [("0.1", "image", "i.png", 4), ("0.3", "audio", "s", 50)]
    assert got[1].attachment_tokens == 54 and got[None].loss == ""
    assert chat.format_conversations(spark.createDataFrame([], schema)).count() == 0


def test_leaks(spark, cases):
    item = "Yesterday Alice bought 12 apples for 30 dollars and then Alice gave Bob 12 apples because Bob likes fruit very much today"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "only three words")], "item_id bigint, text string")
    docs = [
        (1, item.replace("Alice", "Carol").replace("Bob", "Dave").replace("12", "7")),  # asked again with other values
        (2, "Yesterday Carol bought 7 apples for 44 dollars and then Erin gave Dave 9 apples because Ann likes fruit very much"),
        (3, "before it " + item.upper() + " behind it"),
        (4, "so only three words are here"),
        (5, "nothing at all of it in these words here"),
        (None, item),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(df, bench).collect()}
    assert set(got) == {(1, 1), (3, 1), (4, 3)}
    assert not got[1, 1].exact and got[3, 1].exact
    assert decontaminate.leaks(cases, bench).count() == 0
    assert decontaminate.leaks(df.limit(0), bench).count() == decontaminate.leaks(df, bench.limit(0)).count() == 0


def test_leaks_beside_other_variants(spark):
    item = "A farmer sells 12 crates for 30 coins each day at the market"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    variant = lambda a, b: item.replace("12", str(a)).replace("30", str(b))
    docs = [(n, f"{item}. {variant(n, 3 * n + 1)}.") for n in range(40, 52)]
    docs += [(100 + n, f"{variant(n, n + 1)}. some words between. {variant(n + 2, n + 3)}.") for n in range(40, 52)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(df, bench).collect()}
    assert set(got) == {d for d, _ in docs}
    assert all(r.exact == (d < 100) and r.n_windows == r.n_item_windows == 6 for d, r in got.items())


def test_leaks_dense_in_numbers(spark):
    items = [(1, "Compute 12 times 30 plus 5"), (2, "12 30 5"), (3, "Take 3 from 4 km and 5 from 6 km and 7 from 8 km"), (4, "12")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [
        (1, "please compute 12 times 30, plus 5 now"), (2, "it is 12 30 5"), (3, "x " + items[2][1] + " y"),
        (4, "please compute 13 times 30 plus 5 now"), (5, "take 4 from 4 km and 5 from 7 km and 7 from 9 km"),
    ]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(df, bench).collect()}
    assert set(got) == {(1, 1), (1, 4), (2, 2), (2, 4), (3, 3)} and all(r.exact for r in got.values())


def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = texts_of(frame, "doc_id", "text")
    kept = corpus_pipeline.STAGES[0][1](spark, frame, SMALL)
    assert kept.columns == frame.columns and kept.count() <= texts.count()
    poor = corpus_pipeline.STAGES[1][1](spark, kept, SMALL)
    left = {r.doc_id: r.text for r in poor.collect()}
    roots = _components(left, 5)
    one = {d: t for d, t in left.items() if roots[d] == d}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {d for d, t in one.items() if not any(i in t for i in items)}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == clean and len(got) == len(clean) <= len(docs)
    for r in got[:50]:
        assert hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and len(r.ids) == 4 * r.n_tokens


def test_pipeline_keeps_one_of_equal_rows(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A b c d e f g"), (None, "a b c d e f g"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept", F.lit(1))
    got = corpus_pipeline.drop_copies(spark, df, SMALL).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 3]


def test_pipeline_judges_rows_without_id(spark):
    leak = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, f"{words} end{i % 2}") for i in range(6)] + [(None, None), (None, ""), (7, words), (8, f"so {leak}"), (None, f"so {leak}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_copies(spark, df, SMALL).collect()]
    assert sum(d is None and (t or "").startswith("w0 ") for d, t in got) == 1
    assert sum(d is None and not t for d, t in got) == 1 and len(got) == 5
    left = [(r.doc_id, r.text) for r in corpus_pipeline.drop_leaks(spark, df, SMALL).collect()]
    assert len(left) == 9 and not any(leak in (t or "") for _, t in left)


def test_codes_of_plain_words_need_no_pattern(monkeypatch):
    from foretell.llm import decontaminate as D

    def by_pattern(run):
        bare = D._BARE.sub("", run)
        if not bare:
            return 0
        word = bare.lower()
        flags = D._CAPITAL * bare[0].isupper() | D._ENDS * (run[-1] in ".!?:")
        flags |= D._NUMBER if any(c.isdigit() for c in bare) else D._UNIT * (word in D.UNITS)
        return D.xxhash.xxh64_intdigest(word) & ~15 | flags

    plain = ["word", "Word.", "km,", "12", "3a:", "É!", "x²", "½", "²", "Ⅳ?", "ab)", "٣", "word…", "日本。"]
    odd = ["_", "a_", "_a", "a-b", "(a)", "a_b.", "...", ".", "é", "áb", "don't"]
    wanted = [by_pattern(run) for run in plain + odd]
    assert [D._code(run) for run in plain + odd] == wanted
    monkeypatch.setattr(D, "_BARE", None)
    assert [D._code(run) for run in plain] == wanted[: len(plain)]
    texts = ["One two.\n\n three\n--\nFour 5 km, six _\n", "", "\n", "__\n a"]
    assert [len(D.template(text, by_pattern_ends(D))[0]) for text in texts] == [7, 0, 0, 1]


def by_pattern_ends(D):
    return {r: D.xxhash.xxh64_intdigest(r) & ~15 if r.strip("_-") else 0 for r in "One two. three -- Four 5 km, six _ __ a".split()}.__getitem__

"""Operators beyond their registered queries."""

import pickle
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import audited, awkward, collected, expected, middle_row, near_components, table_of

import corpus_pipeline
from busgrid.llm import (
    audit,
    bpe,
    golay,
    jaccard,
    middle,
    mixing,
    pii,
    pivots,
    pretokens,
    quality,
    repeats,
    simhash,
    token_files,
    toxicity,
    wordruns,
)
from busgrid.llm.common import text_bytes
from busgrid.llm.components import components


def test_cuts_are_those_of_the_pattern():
    rng = random.Random(1)
    letters = "ab'sdtmrevlé1²½ \n\t\xa0\x85.,!-A  '''  ɏɀ\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["日本 x's", "a𝕏'll  b", "", None]
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    want = []
    for at, text in zip(offsets, texts, strict=False):
        for piece in pretokens.PATTERN.findall(text or ""):
            want.append(int(at))
            at += len(piece.encode())
    assert pretokens.cuts(data, offsets).tolist() == want


def test_token_files_can_be_looked_up(spark, tmp_path):
    rows = [(i, f"text number {i}") for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "ids")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(frame, path, vocabulary)
    every = {r.doc_id: r for r in token_files.read(spark, path).collect()}
    some = {r.doc_id: r for r in token_files.read(spark, path, [7, 333, 9999]).collect()}
    assert sorted(some) == [7, 333]
    assert all(some[i].start == every[i].start and some[i].ids == every[i].ids for i in some)
    plan = token_files.read(spark, path, [7])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)" in plan or "In(doc_id" in plan


def test_special_tokens_in_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["a <|endoftext|> b", "plain", "<|endoftext|><|endoftext|>", "日本 <|endoftext|", "<|endof", "text|>", ""]
    data, offsets = text_bytes(pa.array(texts))
    for as_text in (False, True):
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = as_text
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        found = token_files.Encoder(path, as_text).encode_rows(data, offsets)
        assert [i.tolist() for i in found] == want
    assert 50256 in token_files.Encoder(path).encode_rows(data, offsets)[0]


def test_bpe_decodes_to_the_text(spark):
    rows = [(i, t) for i, t in awkward() if i is not None]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    path = public_tokenizers.path(bpe.VOCABULARY)
    found = bpe.decode(bpe.encode(frame, path), path)
    assert collected(found, ["doc_id", "text"]) == expected([(i, t or "") for i, t in rows])


@pytest.mark.parametrize("group", [256, 16])
def test_families_in_groups(spark, tmp_path, monkeypatch, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "HUB", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(words) for _ in range(n)] for n in (3, 8, 40, 40, 120)]
    rows = []
    for i in range(400):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text[: rng.randint(1, len(text))] if rng.random() < 0.3 else text)))
    table_of(spark, str(tmp_path), rows, clashing=False)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = jaccard.join(frame)
    want = near_components(rows)
    assert collected(found, ["doc_id", "n_shingles", "component_id"]) == expected(want)
    kept = jaccard.one_of_each(frame)
    assert {r.doc_id for r in kept.collect()} == {component for _, _, component in want}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(30)]
    links += [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(30)] + [(7, 7)]
    rng.shuffle(links)
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for u, v in links:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "u long, v long")
    found = {r.node: r.root for r in components(frame).collect()}
    linked = {i for u, v in links if u != v for i in (u, v)}
    assert found == {i: root(i) for i in linked}


def test_levels_merge_by_size():
    levels = repeats.Levels()
    none = np.zeros(10, np.uint64)
    for i in range(37):
        keys = np.sort(np.random.default_rng(i).integers(0, 1000, 10).astype(np.uint64))
        levels.add(keys, none, np.full(10, i))
        sizes = [len(level[0]) for level in levels.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
        assert len(sizes) <= 8


def test_words_that_disclose(spark):
    rng = random.Random(2)
    filler = "lorem ipsum dolor amet consect etur adipis elit tempor labore magna aliqua".split()
    rows = []
    for i in range(300):
        words = [rng.choice(filler) for _ in range(40)]
        if i % 30 == 0:
            words.insert(rng.randint(5, 30), "Zorblat bob@corp.com")
        rows.append((i, " ".join(words), 0))
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    texts = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert all(("[EMAIL]" in t) == (i % 30 == 0) for i, t in texts.items())
    assert not any("zorblat" in t.lower() for t in texts.values())
    assert all(texts[i] == t for i, t, _ in rows if i % 30)


def test_words_go_from_texts_without_an_id(spark):
    rng = random.Random(3)
    filler = "lorem ipsum dolor amet consect etur adipis elit tempor labore magna aliqua".split()
    some = lambda: " ".join(rng.choice(filler) for _ in range(10))
    rows = [(i, f"{some()} {some()}") for i in range(200)]
    rows += [(None, f"{some()} Zorblat bob@corp.com {some()}") for _ in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [r.text for r in pii.sanitise(frame).collect()]
    assert len(texts) == len(rows) and sum("[EMAIL]" in t for t in texts) == 8
    assert not any("zorblat" in t.lower() for t in texts)


def test_texts_without_an_id_lose_only_their_own_words(spark):
    rng = random.Random(3)
    filler = "lorem ipsum dolor amet consect etur adipis elit tempor labore magna aliqua".split()
    some = lambda: " ".join(rng.choice(filler) for _ in range(10))
    rows = [(i, f"{some()} {some()}") for i in range(200)]
    for key in (None, 7):
        rows += [(key, f"{some()} Zorblat bob{key}@corp.com {some()}") for _ in range(8)]
        rows += [(key, "the city of Zorblat is nice")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [r.text for r in pii.sanitise(frame).collect()]
    assert sum("zorblat" in t.lower() for t in texts) == 2
    assert texts.count("the city of Zorblat is nice") == 2


def test_spans_that_overlap_and_many_of_them(spark):
    def brute(text, spans):
        out, at = "", 0
        for start, end, kind in sorted(spans):
            if start >= at:
                out += text[at:start] + ("" if kind == "remove" else f"[{kind.upper()}]")
            at = max(at, end)
        return out + text[at:]

    rng = random.Random(1)
    parts = ["é", "joe@10.20.30.40", "a@b.cz", " ", "x ", "+420 123 456 789 012 345", "4111 1111 1111 1111", "1.2.3.4"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 40, 1500])))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    spans = {r.doc_id: [(s.start, s.end, s.kind) for s in r["_all"]] for r in pii.sanitised_spans(frame).collect()}
    assert found == {i: brute(t, spans[i]) for i, t in rows}


def test_copies_of_a_text_disclose_nothing(spark):
    rows = [(i, "unusual word here bob@corp.com and after it") for i in range(50)]
    rows += [(100 + i, "something else altogether") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.text for r in pii.sanitise(frame).collect()} == {
        "unusual word here [EMAIL] and after it",
        "something else altogether",
    }


def test_overlapping_spans_are_replaced_whole(spark):
    frame = spark.createDataFrame([(1, "x joe@10.20.30.40 y")], "doc_id long, text string")
    (row,) = pii.sanitise(frame).collect()
    assert row.text == "x [EMAIL] y"


def test_many_spans_keep_their_places(spark):
    frame = spark.createDataFrame([(1, "é a@b.cz " * 1000)], "doc_id long, text string")
    (row,) = pii.sanitised_spans(frame).collect()
    assert [(s.start, s.end) for s in row["_base"]] == [(2 + 9 * i, 8 + 9 * i) for i in range(1000)]


@pytest.mark.parametrize("block,held", [(3, 50), (2048, 1 << 16)])
def test_top_k_with_unsound_vectors_and_repeated_ids(spark, block, held):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 6)]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(30)]  # ties
    rows += [(7, rows[7][1]), (50, rows[50][1]), (60, rows[9][1]), (100, rows[0][1]), (8, [0.9] * 6)]
    sound = list(rows)
    rows += [(950, None), (951, [1.0, None] + [0.0] * 4), (952, [float("nan")] * 6)]
    rows += [(953, [float("inf")] * 6), (954, [1.0, 2.0]), (None, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    frame = frame.selectExpr("*", "1 as score", "2 as rank", "3 as v", "4 as row")
    vectors = pivots.usable(frame)
    found = pivots.top_k(vectors, pivots.F.col("vec_id") % 50 == 0, 5, block=block, held=held)
    grid = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in sound]
    want = []
    for n, (q, mine) in enumerate(grid):
        if q % 50 == 0:
            scores = sorted((-int(mine @ x), c) for m, (c, x) in enumerate(grid) if m != n)
            want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:5])]
    assert collected(found, ["query_id", "rank", "vec_id", "score"]) == expected(want)


def test_the_best_of_repeated_ids_is_found(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.0]), (1, [0.1, 0.0]), (2, [0.2, 0.0]), (2, [0.2, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = pivots.top_k(pivots.usable(frame), pivots.F.col("vec_id") == 0, 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 58880), (2, 13056), (2, 13056), (1, 6400)]


def test_trees_are_monotonic():
    rng = np.random.default_rng(3)
    x = rng.random((2000, len(quality.FEATURES)))
    y = (x[:, 2] + 0.5 * rng.random(2000) + (x[:, 0] > 0.5) < 1.0).astype(float)
    signs = np.array([quality.MONOTONIC.get(f, 0) for f in quality.FEATURES])
    trees = quality.train(x, y, signs)
    for feature in np.flatnonzero(signs):
        low, high = x[:300].copy(), x[:300].copy()
        high[:, feature] = low[:, feature] + rng.random(300)
        assert (trees.score(high) <= trees.score(low) + 1e-12).all()
    assert ((trees.score(x) >= 0.5) == (y == 1)).mean() > 0.85


def test_search_finds_the_exact_neighbours():
    rng = np.random.default_rng(4)
    terms = np.arange(50, dtype=np.uint64)
    idf = rng.random(50) + 1
    examples = []
    for i in range(700):
        t = np.sort(rng.choice(50, rng.integers(1, 6), replace=False))
        examples.append((i, int(rng.random() < 0.3), t, rng.integers(1, 4, len(t))))
    index = toxicity.build(terms, idf, examples)
    dense = np.zeros((700, 50))
    for k, (i, _, t, c) in enumerate(examples):
        dense[k, t] = index.vector(t, c)
    by_id = {e[0]: k for k, e in enumerate(examples)}
    for _, _, t, c in examples[:60]:
        query = np.zeros(50)
        query[t] = index.vector(t, c)
        found, sims = index.search(t, index.vector(t, c), 15)
        best = np.sort(dense @ query)[::-1][:15]
        assert np.allclose(sims, best)
        assert np.allclose([dense[by_id[index.ids[f]]] @ query for f in found], sims)


@pytest.mark.parametrize("many,rows", [(128, 256), (5, 3)])
@pytest.mark.parametrize("groups", [1, 4])
def test_whole_texts_find_their_exact_neighbours(monkeypatch, many, rows, groups):
    """Of texts in several vocabularies, with shared and rare words, repeated texts and ties."""
    monkeypatch.setattr(toxicity, "TEXTS", many)
    monkeypatch.setattr(toxicity, "ROWS", rows)
    monkeypatch.setattr(toxicity, "_IN_HAND", {})
    rng = np.random.default_rng(5)
    n_words, n = 400, 1200
    words = np.sort(rng.integers(0, 2**64 - 1, n_words, dtype=np.uint64, endpoint=True))
    given = []
    for i in range(n):
        if i % 10 == 9:
            given.append(given[i - 1 - i % 3])
            continue
        own = np.arange(i % groups, n_words - 40, groups)
        share = 1 / np.arange(1, len(own) + 1)
        some = rng.choice(own, rng.integers(1, 40), replace=False, p=share / share.sum())
        some = np.append(some, rng.choice(np.arange(n_words - 40, n_words), rng.integers(0, 3), replace=False))
        given.append((np.sort(some), rng.integers(1, 6, len(some))))
    edges = np.cumsum([0, *[len(w) for w, _ in given]])
    idf = 1 + rng.random(n_words)
    texts = toxicity.Texts(
        words, idf, 5.0, np.arange(n) * 7, rng.integers(0, 2, n).astype(float), edges,
        np.concatenate([w for w, _ in given]).astype(np.int32),
        np.concatenate([c for _, c in given]).astype(np.int32), rng.random(n_words) < 0.1,
    )
    assert groups == 1 or len(np.unique(texts.kind)) > 1
    vectors = np.zeros((n, n_words))
    for i, (w, c) in enumerate(given):
        vectors[i, w] = (1 + np.log(c)) * idf[w]
    vectors /= np.sqrt((vectors**2).sum(axis=1))[:, None]
    texts = pickle.loads(pickle.dumps(texts))
    queries = [(w, c, 0.0) for w, c in given]
    for skip in (None, list(range(n))):
        for i, (found, sims, _) in enumerate(texts.near(queries, 15, skip)):
            want = vectors @ vectors[i]
            if skip:
                want[i] = 0
            best = np.lexsort((texts.ids, -np.round(want, 12)))[:15]
            best = best[want[best] > 0]
            assert list(found) == list(best) and np.allclose(sims, want[best])


def test_hashes_are_found_from_their_leading_bits():
    rng = np.random.default_rng(6)
    even = rng.integers(0, 2**64 - 1, 3000, dtype=np.uint64, endpoint=True)
    close = np.append(np.arange(500, dtype=np.uint64), np.uint64(2**64 - 1) - np.arange(500, dtype=np.uint64))
    for words in (np.unique(even), np.unique(close), even[:1], even[:0]):
        asked = np.concatenate([words, words + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        number = {int(w): i for i, w in enumerate(words)}
        assert list(toxicity.Places(words)(asked)) == [number.get(int(a), -1) for a in asked]


def test_small_sources_stop_at_three_times_their_size(spark):
    rows = [(i, "a b c d", "big") for i in range(90)] + [(100 + i, "a b", "small") for i in range(3)]
    rows += [(200, "x y z", None), (201, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame).toPandas().set_index("doc_id")
    total = 90 * 4 + 6 + 3
    assert found.loc[100].target == 18 and found.loc[200].target == 9
    assert abs(found.loc[0].target - (total - 18 - 9)) < 1e-9
    assert (found.loc[[100, 101, 102]].taken == 6).all()
    many = mixing.mixed(frame).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert many.loc[100] == 3


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "personal_data", "mix", "encode"]
    kept = corpus_pipeline.language(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(map(str.isalpha, t or "")) for _, t in rows)
    one = corpus_pipeline.near_copies(spark, docs, sf_dir)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in near_components(rows)})
    clean = corpus_pipeline.personal_data(spark, docs, sf_dir)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert not clean.where("text rlike '[A-Za-z0-9]@[a-z0-9]+[.][a-z]'").count()
    last = corpus_pipeline.run(spark, sf_dir)
    assert last.columns == ["doc_id", "n_tokens", "ids"] and last.count()


def test_a_corpus_without_languages_stays(spark, tmp_path):
    rows = [(i, t, None, "s", None) for i, t in [(1, "some text"), (2, None), (3, "12 !"), (4, "日本")]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.language(spark, frame, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


ODD_NAMES = ["_t", "_m", "_of", "_general", "_id", "_hash", "_row", "_all", "_n", "meta.url", "a`b", "row", "digest", "kept_id"]


@pytest.mark.parametrize("name", ["language", "near_copies", "personal_data", "mix"])
@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_of_any_name(spark, sf_dir, name, empty):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if empty:
        docs = docs.limit(0)
    odd = docs.select("*", *[audit.F.lit(i).alias(c) for i, c in enumerate(ODD_NAMES)])
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, odd, sf_dir)
    assert found.columns == odd.columns
    plain = stage(spark, docs, sf_dir)
    rows = found.collect()
    assert collected(plain, docs.columns) == sorted(tuple("" if v is None else str(v) for v in r[: len(docs.columns)]) for r in rows)
    assert all(tuple(r)[len(docs.columns) :] == tuple(range(len(ODD_NAMES))) for r in rows)
    if empty:
        assert rows == []


def test_last_stage_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert corpus_pipeline.encode(spark, docs, sf_dir).collect() == []


def test_pipeline_on_awkward_rows(spark, tmp_path):
    table_of(spark, str(tmp_path), awkward())
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)


def test_copies_of_labelled_texts_are_judged_by_them(spark):
    rng = random.Random(7)
    common = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    rows = [(i, " ".join(rng.choice(common) for _ in range(30)) + (" vile" if i % 8 == 0 else ""))
            for i in range(400)]
    once = " ".join(rng.choice(common) for _ in range(30)) + " blackguard"
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows += [(i, once) for i in range(1000, 1100)] + [(2000, "hm"), (2001, "hm hm"), (2002, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i % 8 == 0)) for i in range(400)] + [(i, 1) for i in range(1000, 1100)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    index, texts = toxicity.fit(frame, labels)
    found = {r.doc_id: r for r in toxicity.score(frame, index, texts).collect()}
    assert len(found) == len(rows) and held
    assert all(found[i].predicted == 1 and found[i].evidence[0].similarity > 1 - 1e-9 for i in held)
    # The neighbours are those of a cosine over all words of all texts.
    split = {i: (t or "").split() for i, t in rows}
    df = {}
    for words in split.values():
        for w in set(words):
            df[w] = df.get(w, 0) + 1

    def vector(words):
        v = {w: (1 + np.log(words.count(w))) * (np.log((1 + len(rows)) / (1 + df[w])) + 1) for w in set(words)}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vectors = {i: vector(w) for i, w in split.items() if w}
    known = {i for i, _ in marks if zlib.crc32(str(i).encode()) % 5}
    for i in (5, 8, 77, 399):
        sims = sorted((-sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()), j) for j in known)
        assert np.allclose([e.similarity for e in found[i].evidence], [-s for s, _ in sims[:3]])


def test_every_number_is_near_one_codeword():
    values = np.arange(1 << golay.LENGTH)
    row, word = golay.anchors(values[::37], 0)
    assert (row == np.arange(len(row))).all() and len(row) == len(values[::37])
    assert len(np.unique(word)) == 1 << golay.MESSAGE_BITS
    # Codewords up to two bits beyond the radius are those found by looking at all of them.
    nearest = golay.syndromes(values) == 0
    words = values[nearest]
    for value in (0, 1, 12345, golay.MASK):
        far = np.bitwise_count(words ^ value)
        for excess in (1, 2):
            _, found = golay.anchors(np.array([value]), excess)
            assert sorted(found) == sorted(words[far == 3 + excess] >> golay.CHECK_BITS)


@pytest.mark.parametrize("blocks,group,pairs", [(2, 4096, 1 << 21), (2, 8, 50), (3, 64, 1 << 21)])
@pytest.mark.parametrize("threshold", [3, 4])
def test_no_link_of_fingerprints_is_missed(spark, monkeypatch, blocks, group, pairs, threshold):
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(9)
    prints = set()
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(60):
            prints.add(base ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(9))))
    prints = np.sort(np.array(sorted(prints), np.uint64).view(np.int64))
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp long").repartition(3)
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k in range(len(prints)):
        close = np.bitwise_count((prints[:k] ^ prints[k]).view(np.uint64)) <= threshold
        for z in np.flatnonzero(close).tolist():
            a, b = root(k), root(z)
            parent[max(a, b)] = min(a, b)
    want = {int(p): int(prints[root(k)]) for k, p in enumerate(prints)}
    found = {r.node: r.root for r in components(simhash.links(frame, threshold, blocks)).collect()}
    assert {p: found.get(p, p) for p in want} == want


def test_long_texts_have_the_words_of_their_runs():
    rng = random.Random(3)
    text = "".join(rng.choice("ab é\n\t\x0b") for _ in range(5000)).encode()
    for most in (1, 7, 100, 10_000):
        assert [w for run in wordruns.word_runs(text, most) for w in run] == text.split()
    whole = simhash.fingerprint(text)
    pieces = wordruns.word_runs
    try:
        simhash.word_runs = lambda t: pieces(t, 40)
        assert simhash.fingerprint(text) == whole
    finally:
        simhash.word_runs = pieces


def test_fill_in_middle_of_very_long_and_odd_texts(spark):
    texts = ["x\n" * 1_000_000, "a" * 3_000_000, "a\n\n\n", "\r\nb\u2028c\x85d\re\n", "<S", "<<", "$1 \\n \\\n$3\n"]
    texts += ["a <P> b\nc", "日本\n😀\n<S>"]
    rows = list(enumerate(texts)) + [(100 + i, f"{i}\n<\n{i * i}<P\n>S>\n") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    columns = "doc_id n form prefix_chars middle_chars".split()
    made = middle.transform(frame)
    assert collected(made, columns) == expected([middle_row(*r)[:5] for r in rows])
    back = made.select("doc_id", middle.restored(middle.F.col("form"), middle.F.col("output")).alias("t"))
    assert {r.doc_id: r.t for r in back.collect()} == dict(rows)


def test_sentinels_of_ones_own(spark):
    rows = [(i, f"{i}\n$\nb\\{i}\n" * 3) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    own = ("[$pre]", "[\\suf]", "[mid]")
    made = middle.transform(frame, own, seed=1, rate=50)
    forms = {r.form for r in made.collect()}
    assert forms == {"plain", "psm", "spm"}
    back = made.select("doc_id", middle.restored(middle.F.col("form"), middle.F.col("output"), own).alias("t"))
    assert {r.doc_id: r.t for r in back.collect()} == dict(rows)
    with pytest.raises(ValueError):
        middle.transform(frame, ("<P>", "<P>", "<M>"))


def test_unions_by_galloping():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 200, rng.integers(0, 120))) for _ in range(2))
        assert audit.merged(a, b).tolist() == sorted(set(a) | set(b))
        assert audit.common(a, b) == len(set(a) & set(b))


@pytest.mark.parametrize("run", [1 << 16, 7])
def test_audit_in_many_id_ranges(spark, monkeypatch, run):
    monkeypatch.setattr(audit, "RUN", run)
    rng = random.Random(8)
    texts = ["word " * 250, " ".join(f"w{i}" for i in range(220)), "SHOUT " * 300, "a # b", "", None]
    docs = [(rng.randrange(300), rng.choice(["en", "de", None, ""]), rng.choice(texts)) for _ in range(400)]
    docs += [(None, "en", "x"), (None, "en", "x"), (5, "xx", "x")]
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(150)] * 2 + [(None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(5)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    labels = labels.selectExpr("*", "1 as flags", "2 as marks", "'x' as part", "'y' as lang")
    found = audit.audit(frame, labels)
    columns = "part filter_order step filter kept removed redundant unique_fails good_lost toxic_lost shapley"
    assert collected(found, columns.split()) == expected(audited(docs, marks))

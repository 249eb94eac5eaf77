"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from chartlens.llm import filteraudit, fingerprints, language, mixing, neardup, packing, sharding, tokencount, topk, toxicity, urlfilter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, id string, part string, score string"
LONG = "lorem ipsum dolor sit amet consectetur " * 30000

ROWS = [
    (1, "one two three four five six\nseven eight nine ten", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b ", "fr", None),
    (5, "Zwei", "de", "b"),
    (5, "Zwei", "de", "b"),
    (6, LONG, "la", "a"),
    (7, "word" * 100000, "en", "b"),
    (None, "no id here at all", "en", "b"),
    (None, None, "en", "b"),
    (8, "one two three four five six\nseven eight nine ten", "en", "c"),
    (9, "ÀÉ 日本語 ▁ \u0000 <s> <|endoftext|> it's", "xx", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), 7, "x", "y", "z") for r in ROWS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (5, 1, 1), (6, 0, None), (None, 0, 1), (7, 0, 1), (9, 0, 0), (9, 0, 0), (77, 0, 1)],
        "doc_id long, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, name="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[name], []).append(r)
    return out


def test_fingerprints(docs, nothing):
    rows = by_id(fingerprints.edit_likeness(docs))
    assert sum(map(len, rows.values())) == len(ROWS)
    assert rows[1][0]["fingerprint"] == rows[8][0]["fingerprint"]
    assert rows[2][0]["fingerprint"] == rows[3][0]["fingerprint"]
    assert rows[2][0]["n_chars"] == 0 and rows[6][0]["n_chars"] == len(LONG)
    assert fingerprints.edit_likeness(nothing).count() == 0
    alone = fingerprints.edit_likeness(docs.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(nothing).count() == 0


def test_fingerprint_algebra():
    whole, part = (fingerprints.encoded(*fingerprints.fingerprints([t]))[0] for t in ("b\na\nc\na", "a\nc\nb"))
    assert fingerprints.encoded(*fingerprints.fingerprints(["a\na\nb\nc"]))[0] == whole
    assert fingerprints.insert(part, "a") == whole
    assert fingerprints.insert(whole, "a", -1) == part
    # a row longer than a batch is summed in stretches
    long = ["x" * 5, "y " * (5 * fingerprints.BATCH_BYTES // 2), "tail"]
    together = fingerprints.likeness_lanes([[p.encode() for p in long]])[0]
    apart = sum(fingerprints.likeness_lanes([[p.encode()]])[0].astype(np.int64) for p in long)
    assert (together == apart.astype(np.uint16)).all()


def test_likeness_of_repetition():
    """Lanes beyond 16 bits: two thirds of a long run, and a line repeated 100,000 times."""
    for text in ("x" * 40_000, "0123456789 abc\n" * 100_000):
        equal, like = fingerprints.fingerprints([text, text[: len(text) * 2 // 3] + "other words at the end"])
        again = [fingerprints.decoded(f) for f in fingerprints.encoded(equal, like)]
        (a, x), (b, y) = again
        assert fingerprints.likeness(a[None], x[None], b[None], y[None])[0] > 0.99
    once, line = fingerprints.encoded(*fingerprints.fingerprints(["", "a line"]))
    assert fingerprints.insert(fingerprints.insert(line, "a line", 40_000), "a line", -40_001) == once


def test_near_duplicates(docs, nothing):
    rows = by_id(neardup.near_duplicates(docs, k=4))
    assert sum(map(len, rows.values())) == len(ROWS)
    assert [r["component_id"] for r in rows[8]] == [1] and not rows[8][0]["kept"]
    assert all(r["component_id"] == 5 and r["kept"] for r in rows[5])
    for d in (2, 3, 4):
        assert (rows[d][0]["n_shingles"], rows[d][0]["component_id"], rows[d][0]["kept"]) == (0, d, True)
    assert rows[7][0]["n_shingles"] == 1 and rows[6][0]["n_shingles"] == 6
    assert all(r["component_id"] is None and r["kept"] for r in rows[None])
    assert neardup.near_duplicates(nothing).count() == 0
    left = neardup.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 9]


def test_keep_one_of_ids_with_several_texts(spark):
    """No text without a kept copy is lost where rows of different texts share a doc_id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (7, a), (7, b), (8, b), (9, c), (9, ""), (9, c + " more"), (9, None), (10, c), (11, "x y"), (11, "x y")]
    docs = spark.createDataFrame([(i, t, "en", str(n)) for n, (i, t) in enumerate(rows)], "doc_id long, text string, sig string, root string")
    left = neardup.keep_one(docs)
    assert left.columns == docs.columns
    got = sorted((r["doc_id"], (r["text"] or "").removesuffix(" more")) for r in left.collect())
    assert got == sorted([(5, a), (7, b), (9, c), (9, ""), (11, "x y")])


def test_near_duplicate_groups(spark):
    """A large group whose members are linked through others only, against brute force."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{rng.integers(10**6)}" for _ in range(30)) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, k=4).collect()}
    sets = [{tuple(t.split()[i : i + 4]) for i in range(len(t.split()) - 3)} for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert found == {i: top(i) for i in range(len(texts))}


def test_estimate():
    """The joint estimate is near the similarity, for equal and unequal sizes."""
    from chartlens.llm.text import mix

    for n_a, n_b, common in ((900, 900, 800), (1000, 820, 810), (50, 50, 45), (3, 3, 3)):
        errors = []
        for seed in range(20):
            x = mix(np.arange(n_a + n_b, dtype=np.uint64), seed + 1)
            a, b = x[:n_a], x[n_a - common : n_a - common + n_b]
            ra, rb = neardup.registers(a).astype(int), neardup.registers(b).astype(int)
            both = neardup.registers(np.concatenate([a, b])).astype(int)
            assert (both == np.maximum(ra, rb)).all()
            j = neardup.estimate([n_a], [n_b], [(ra > rb).sum()], [(ra < rb).sum()])[0]
            errors.append(j - common / (n_a + n_b - common))
        assert abs(np.mean(errors)) < 0.05


def test_mixing(docs, nothing):
    from chartlens.llm.common import words
    from pyspark.sql import functions as F

    rows = mixing.mix_amounts(docs.select("doc_id", "source", words(F.col("text")).alias("size")), block=16).collect()
    assert len(rows) == len(ROWS)
    targets, taken = {}, {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        targets[r["source"]] = r["target"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert taken == {s: int(t) for s, t in targets.items()}
    out = mixing.mix(docs, block=16)
    assert out.columns == docs.columns
    mixed = out.collect()
    assert sum(len(r["text"].split()) for r in mixed) == sum(taken.values())
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
    assert mixing.mix(nothing).count() == 0


def test_mixing_schedule(spark):
    """Every run of slots has the sources in their shares to within a few slots."""
    sizes = spark.createDataFrame([(i, f"s{i % 4}", 500 + i) for i in range(800)], "doc_id long, source string, size long")
    sources = mixing.targets(sizes)
    slots = mixing.schedule(spark, sources, block=64).orderBy("slot").collect()
    share = {r["rank"]: r["target"] for r in sources.collect()}
    total = sum(share.values())
    seen = dict.fromkeys(share, 0)
    for i, r in enumerate(slots):
        seen[r["rank"]] += 1
        assert all(abs(seen[k] - (i + 1) * share[k] / total) < 8 for k in seen)


def _sources_in_order(spark, docs):
    """The mix's words and sources as its partitions have them."""
    from pyspark.sql import functions as F

    rows = mixing.mix(docs, block=32).select("source", F.size(F.split("text", " ")).alias("n"), F.monotonically_increasing_id().alias("i"))
    return [(r["source"], r["n"]) for r in sorted(rows.collect(), key=lambda r: r["i"])]


def _worst(run, share):
    """How many words any prefix of the mix is off a source's share of it."""
    seen, total, worst = dict.fromkeys(share, 0), 0, 0
    for source, n in run:
        seen[source] += n
        total += n
        worst = max([worst, *(abs(seen[s] - total * share[s]) for s in share)])
    return worst


def test_mix_follows_its_schedule(spark, monkeypatch):
    """Every prefix of the mix has the sources in their shares, and only because of the low-discrepancy points."""
    rows = [(i, " ".join(["w"] * (5 + i % 23)), None, f"s{i % 3}", 0, 0, "", "", "") for i in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    run = _sources_in_order(spark, docs)
    total = sum(n for _, n in run)
    share = {s: sum(n for x, n in run if x == s) / total for s in ("s0", "s1", "s2")}
    assert _worst(run, share) < 12 * 32
    sizes = docs.selectExpr("doc_id", "source", "cast(5 + doc_id % 23 as long) as size")
    slots = {r["doc_id"]: (r["taken"], r["first_slot"]) for r in mixing.mix_amounts(sizes, block=32).collect()}
    assert all((taken > 0) == (slot is not None) for taken, slot in slots.values())
    monkeypatch.setattr(mixing, "GOLDEN", 0.0)
    assert _worst(_sources_in_order(spark, docs), share) > total / 10
    other = {r["doc_id"]: (r["taken"], r["first_slot"]) for r in mixing.mix_amounts(sizes, block=32).collect()}
    assert {d: t for d, (t, _) in other.items()} == {d: t for d, (t, _) in slots.items()} and other != slots


def test_token_counts(docs, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokencount.tokenizer_path("piece_bpe_32k.model"))
    rows = tokencount.count_tokens(docs, limit=3).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == sorted(
        (len((t or "").encode()), len(model.encode(t or ""))) for _, t, _, _ in ROWS
    )
    assert all(r["over_limit"] == (r["n_tokens"] > 3) for r in rows)
    assert tokencount.count_tokens(nothing).count() == 0
    counter = tokencount._counter(tokencount.tokenizer_path(tokencount.MODEL))
    odd = [" a", "a ", "a  b", "a \nb", "\n\nb", "a\n", "x ▁ y", "a▁ b", "日本 語", "a b\rc", LONG + "  " + LONG]
    assert counter.count(odd) == [len(model.encode(t)) for t in odd]


def test_packing(docs, nothing):
    rows = packing.pack(docs, max_tokens=64, max_segments=3, max_loss=40).collect()
    assert len({(r["doc_id"], r["start"]) for r in rows if r["doc_id"] not in (None, 5)}) == len(
        [r for r in rows if r["doc_id"] not in (None, 5)]
    )
    sequences = {}
    for r in rows:
        s = sequences.setdefault(r["sequence_id"], [0, 0, 0])
        s[0] += r["length"]
        s[1] += 1
        s[2] += r["loss"]
        assert len(r["ids"]) == 4 * r["length"] > 0
    assert all(s[0] <= 64 and s[1] <= 3 and s[2] <= 40 for s in sequences.values())
    assert by_id(packing.pack(docs))[2][0]["doc_tokens"] == 1
    assert packing.pack(nothing).count() == 0


def test_packing_with_prompts(spark):
    """Instruction data: the prompt's ids bear no loss, and all three limits hold at once."""
    rows = [(i, "why is it so " * (i % 7), "because of that " * (i % 11 + 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, prompt string, text string")
    sequences = {}
    for r in packing.pack(df, max_tokens=128, max_segments=5, max_loss=60, prompt="prompt").collect():
        s = sequences.setdefault(r["sequence_id"], [0, 0, 0])
        s[0] += r["length"]
        s[1] += 1
        s[2] += r["loss"]
    assert all(s[0] <= 128 and s[1] <= 5 and s[2] <= 60 for s in sequences.values())
    assert sum(s[2] for s in sequences.values()) == sum(3 * (i % 11 + 1) + 1 for i in range(200))


@pytest.mark.parametrize("text", [
    "Don't it's I'm 'S", "<|endoftext|>x <|StartOfText|>", "ΑΣ ΣΑΣ", "a\x1c!\x85!b\xa0c", "e\u0301 \u0301x", "ÀÉ µ ß×Þ İ", "!.. ,a.b 12 3",
])
def test_word_encoder(text):
    encoder = packing._encoder(packing.tokenizer_path(packing.MODEL))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text])[0] == np.array(whole, "<u4").tobytes()


def test_top_k(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float((i * j) % 7) / 3 - 1 for j in range(1, 9)], 0) for i in range(300)]
    rows += [(300, None, 0), (301, [], 0), (302, [1.0, None], 0), (303, [nan], 0), (304, [inf, 1.0], 0), (None, [1.0] * 8, 0)]
    rows += [(350, [0.5] * 8, 1), (350, [0.5] * 8, 1), (400, [9.9, -9.9], 1), (305, [1e30] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in topk.top_k(df, vec_id="vec_id").select("query_id", "rank", "vec_id", "score").collect())
    use = []
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) or abs(x) > 1e20 for x in v):
            continue
        use.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (8 - len(v))))
    want = []
    for q in sorted({i for i, _ in use if i % 50 == 0}):
        # every row with another id is a candidate, repeated ones too; a query that repeats meets each once per row
        scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for i, x in use if i == q for c, y in use if c != q)[:5]
        want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    assert got == sorted(want)
    assert topk.top_k(df.where("vec_id < 0")).count() == 0
    assert topk.top_k(df.where("vec_id = 50")).count() == 0


def test_top_k_equals_sql_with_repeated_rows(spark):
    import duckdb

    rows = [(i, [float((i * j) % 11) / 3 - 1 for j in range(1, 7)]) for i in range(260)]
    rows += [rows[7]] * 4 + [rows[100]] * 2 + [(3, [2.0] * 6)] * 3 + [(50, [1.5] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    got = topk.top_k(df).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(topk.OP7_SQL).fetchall())


def test_top_k_deals_by_length(spark, monkeypatch):
    """Lanes of like lengths; lanes too short for a block of queries are not sent to it, and nothing is lost."""
    monkeypatch.setattr(topk, "LANE", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 12)) * rng.gamma(0.5, 1, (3000, 1))
    x[:1000] = x[1]  # a third of all rows are alike
    x[5] = 0
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    c = np.floor(256 * x).astype(np.int64)
    want = []
    for q in range(0, 3000, 50):
        score = c @ c[q]
        order = [int(j) for j in np.lexsort((np.arange(3000), -score)) if j != q][:5]
        want += [(q, r + 1, j, int(score[j])) for r, j in enumerate(order)]
    dealt = []
    plain = topk.deal

    def noted(rows, queries):
        dealt.append(plain(rows, queries, 64, 8))
        return dealt[0]

    monkeypatch.setattr(topk, "deal", noted)
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == want
    candidates, queries = dealt[0]
    lanes = candidates.groupBy("lane", "q_lane").count().collect()
    assert max(r["count"] for r in lanes) <= 2 * 64
    everywhere = 3000 * queries.select("q_lane").distinct().count()
    assert sum(r["count"] for r in lanes) < everywhere / 2  # without bounds every row goes to every block
    assert queries.count() < 60 * candidates.select("lane").distinct().count()


def test_top_k_of_long_vectors(spark):
    """Scaled components of 2^27 and more, and products that only integers tell apart."""
    rows = [(i, [float((i * j) % 7) / 3 - 1 for j in range(1, 9)]) for i in range(120)]
    rows += [(201 + i, [600_000.0 + i, -600_000.0 + i, 1.0, i / 256, 0.0, 0.0, 0.0, 0.0]) for i in range(20)]
    rows += [(300 + i, [4e13, i / 256, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for i in range(3)]
    rows += [(400, [1 / 256, 7 / 256, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([r for r in rows if r[0] != 300], "vec_id long, embedding array<double>")
    use = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i != 300}
    want = []
    for q in use:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(use[q], use[c])), c) for c in use if c != q)[:5]
            want += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    got = topk.top_k(df).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(spark.createDataFrame(rows, df.schema)).collect()


def test_top_k_prunes_without_loss():
    """Several blocks and lanes against a full sort."""
    rng = np.random.default_rng(3)
    c = np.floor(rng.normal(size=(5000, 24)) * rng.gamma(2, 40, (5000, 1)))
    c[1000:2000] = c[0]
    q, ids = c[::250], np.arange(5000)
    basis = np.linalg.eigh(c.T @ c)[1][:, ::-1].copy()
    floor = np.full(len(q), np.iinfo(np.int64).min)
    i, j, score = topk.search(ids[::250], q, floor, ids, c, np.sqrt((c * c).sum(axis=1)), basis, 5)
    for n in range(len(q)):
        s = (c @ q[n]).astype(np.int64)
        want = sorted((-s[k], k) for k in range(5000) if k != ids[::250][n])[:5]
        assert [(-a, b) for a, b in zip(score[i == n], j[i == n])] == want


def _jump(key: int, shards: int) -> int:
    key, at, jump = key % 2**64, -1, 0
    while jump < shards:
        at = jump
        key = (key * 2862933555777941757 + 1) % 2**64
        jump = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_sharding(spark, docs, nothing):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        key = -1 if r["doc_id"] is None else r["doc_id"]
        assert (r["shard"], r["grown_shard"]) == (_jump(key, 24), _jump(key, 25))
        assert r["grown_shard"] in (r["shard"], 24)
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {8}
    assert sharding.shard_documents(nothing).count() == 0
    ids = spark.range(-3000, 3000).selectExpr("id * 1234567891234567 AS doc_id", "'x' AS text")
    rows = sharding.shard_documents(ids, 7).collect()
    assert all(r["shard"] == _jump(r["doc_id"], 7) and r["grown_shard"] in (r["shard"], 7) for r in rows)
    assert max(np.bincount([r["shard"] for r in rows])) < 1.2 * len(rows) / 7


def test_write_shards(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "out"), shards=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


def test_toxicity(docs, labels, nothing):
    rows = by_id(toxicity.toxicity(docs, labels))
    assert sum(map(len, rows.values())) == len(ROWS)
    assert all(0 <= r["score"] <= 1 for part in rows.values() for r in part)
    assert toxicity.toxicity(nothing, labels).count() == 0
    none = toxicity.toxicity(docs, labels.where("toxic is null")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.drop_toxic(docs, labels.where("doc_id is null")).count() == len(ROWS)


def test_nearest_examples_are_exact(spark):
    """Block-max search against all cosines; blocks are left out."""
    rng = np.random.default_rng(2)
    bad, words = [f"bad{i}" for i in range(9)], [f"w{i}" for i in range(1200)]
    rows = []
    for i in range(900):
        topic = i % 4 * 300  # a text's words are of one of four topics, with some common ones
        text = [*rng.choice(words[topic : topic + 300], 40), *rng.choice(words[:30], 8)]
        rows.append((i, " ".join(rng.permutation(text + (list(rng.choice(bad, rng.integers(1, 5))) if i % 3 == 0 else []))), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    n = len(model.ids)
    owner = np.repeat(np.arange(n), model.size)
    weight = toxicity.unit_weights(owner, model.number, model.count, model.idf, n).astype(np.float32)
    dense = np.zeros((n, len(model.terms.terms)))
    dense[owner, model.number] = weight
    index, k = model.index, toxicity.NEIGHBOURS
    assert sorted(index.order) == list(range(n)) and index.blocks > 4
    # every bound holds for every example of its block
    most = np.zeros((dense.shape[1], index.blocks))
    most[index.column >= 0] = index.head_most
    for t in range(dense.shape[1]):
        for c in range(index.cells[t], index.cells[t + 1]):
            most[t, index.cell_block[c]] = index.cell_most[c]
    for p, e in enumerate(index.order):
        assert (dense[e] <= most[:, p // toxicity.BLOCK]).all()
    texts = [r[1] for r in rows[:200]] + ["", "unknown", "w1", "bad1 bad1 bad2", "w1 " * 1000]
    vectors = model.vectors(texts)
    for (x, w), (at, got) in zip(vectors, model.neighbours(vectors)):
        q = np.zeros(dense.shape[1])
        q[x] = w
        want = sorted((-c, i) for i, c in enumerate(np.round(dense @ q, 12)) if c > 0)[:k]
        assert np.allclose([-c for c, _ in want], got, atol=1e-11, rtol=0)
        assert [i for _, i in want] == list(at) or len(set(np.round(got, 11))) < len(got)
    assert 0 < index.read < 0.75 * index.asked
    own = model.own_votes(0, n)
    for i in range(0, n, 17):
        cosine = np.round(dense[i] @ dense.T, 6)
        cosine[i] = 0
        at = sorted(range(n), key=lambda j: (-cosine[j], j))[:k]
        w = cosine[at] ** 2
        assert abs(own[i] - ((w * model.toxic[at]).sum() + toxicity.FAINT * model.prior) / (w.sum() + toxicity.FAINT)) < 1e-4
    scored = toxicity.toxicity(docs, docs.select("doc_id", "toxic")).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in scored]) > 0.97


def test_toxicity_terms():
    x, owner = toxicity.words(["Ab, ab!", "", "É é x1", "\u65e5\u672c a"])
    assert owner.tolist() == [0, 0, 2, 2, 2, 3, 3, 3]
    assert x[0] == x[1] and x[2] == x[3] and len(set(x.tolist())) == 6


def test_rare_toxic_words(spark):
    """A text equal to the only toxic example of its language; its words are too rare for a significance test."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*rng.choice(words, 40), *(["awful"] if i % 3 == 0 else [])]), int(i % 3 == 0)) for i in range(200)]
    lone = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT)
    rows += [(lone, "žluťoučký kůň příšerně úpěl", 1), (2000, "žluťoučký kůň příšerně úpěl", None), (2001, "w1 w2 w3", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = by_id(toxicity.toxicity(docs, docs.select("doc_id", "toxic")))
    (copy,), (clean,) = found[2000], found[2001]
    assert copy["evidence"][0]["doc_id"] == lone and copy["evidence"][0]["toxic"] == 1
    assert abs(copy["evidence"][0]["cosine"] - 1) < 1e-6
    assert copy["predicted"] == 1 and clean["predicted"] == 0


def test_language(docs, nothing):
    rows = language.identify(language.document_evidence(docs), ["doc_id"]).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r["doc_id"] in (2, 3, 4):
            assert (r["language"], r["accepted"]) == ("und", False)
    assert language.identify(language.document_evidence(nothing), ["doc_id"]).count() == 0
    left = language.keep_known(docs)
    assert left.columns == docs.columns
    assert not {2, 3, 4} & {r["doc_id"] for r in left.collect()}


def test_more_than_64_languages(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(70):  # the last six are declared least often
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
        code = f"{chr(97 + i // 26)}{chr(97 + i % 26)}"
        for n in range(4 if i < 64 else 3):
            declared = (code, f"{code.upper()}-US", f"{code}_gb", code)[n]
            rows.append((100 * i + n, " ".join(rng.choice(words, 60)), declared, f"host{i % 5}"))
        rows.append((100 * i + 50, " ".join(rng.choice(words, 60)), None, "host9"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for r in language.identify(language.document_evidence(docs), ["doc_id"]).collect():
        i = r["doc_id"] // 100
        assert (r["language"], r["accepted"]) == (f"{chr(97 + i // 26)}{chr(97 + i % 26)}", True)
        assert r["declared"] in (None, r["language"])
    assert language.keep_known(docs).count() == len(rows)


def test_language_evidence(spark):
    """Markup, suffix and host speak up where the text says little."""
    pages = [(i, f"https://a{i % 3}.shop.de/x", f"<html lang='de'><p>und der die das nicht {i}</p>") for i in range(30)]
    pages += [(100 + i, f"https://b{i % 3}.shop.fr/x", f"<html lang=fr><p>est dans les pour nous {i}</p>") for i in range(30)]
    pages += [(200, "https://a1.shop.de/y", "<html><p>ok</p>"), (201, "http://b1.shop.fr/", "<html lang='fr'><p>ok</p>")]
    pages += [(202, None, None), (203, "no address", "<html lang='de'></html>"), (204, "https://b1.shop.fr/", "<html lang='de'>und nicht der die das")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in language.identify(language.page_evidence(df), ["page_id"]).collect()}
    assert (rows[200]["language"], rows[201]["language"]) == ("de", "fr")
    assert not rows[202]["accepted"] and not rows[203]["accepted"]
    assert rows[204]["language"] == "de"


@pytest.mark.parametrize(("url", "rule", "verdict"), [
    (None, None, "allow"), ("", None, "allow"), ("no-scheme.net/", None, "allow"), ("http://", None, "allow"),
    ("http://NET/", "net/", "block"), ("http://x.net", None, "allow"), ("http://x.net/", "net/", "block"),
    ("http://internet/", None, "allow"), ("http://x.net?/", None, "allow"), ("http://x.net:80/", None, "allow"),
    ("http://example.net/en/", "example.net/en/", "allow"), ("http://a.b.example.net/en/x", "example.net/en/", "allow"),
    ("http://example.net/EN/", "net/", "block"), ("http://notexample.net/en/", "net/", "block"),
    ("ftp://example.com/de/../fr", "example.com/de/", "block"), ("http://example.com/de", None, "allow"),
    ("http://org/fr/?x", "org/fr/", "allow"), ("http://x.org/a/net/", None, "allow"), ("a://b://net/", None, "allow"),
    ("http://x.net/" + "y" * 5000, "net/", "block"), ("http://" + "a." * 3000 + "net/", "net/", "block"),
])
def test_url_rules(spark, url, rule, verdict):
    df = spark.createDataFrame([(1, url, "h", "r"), (1, url, "h", "r")], "page_id long, url string, host string, rule string")
    for r in urlfilter.filter_urls(df).collect():
        assert (r["rule"], r["verdict"]) == (rule, verdict)


def test_many_globs():
    """More than one word of bits, wildcards inside, long and short URLs alike."""
    import re

    rng = np.random.default_rng(4)
    globs = ["".join(rng.choice(list("ab*?"), 5)) + "/" + "".join(rng.choice(list("ab*?/"), rng.integers(0, 6))) for _ in range(60)]
    urls = ["." + "".join(rng.choice(list("ab."), 6)) + "/" + "".join(rng.choice(list("ab/"), rng.integers(0, 9))) for _ in range(400)]
    automaton = urlfilter.Automaton(globs)
    assert automaton.words > 1
    states = automaton.states([u.encode() for u in urls])

    def as_regex(glob):
        host, _, path = glob.partition("/")
        host = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in "*." + host)
        return host + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in "/" + path + "*")

    for u, state in zip(urls, states):
        alone = automaton._alone(u.encode())
        for g, glob in enumerate(globs):
            word, bit = divmod(automaton.ends[g], 64)
            want = re.fullmatch(as_regex(glob), u) is not None
            assert bool(state[word] >> np.uint64(bit) & np.uint64(1)) == want
            assert bool(alone[word] >> np.uint64(bit) & np.uint64(1)) == want


def test_url_filter_empty(spark):
    assert urlfilter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize("builder", [
    lambda docs: filteraudit.failures(docs),
    lambda docs: neardup.sketches(docs, 4),
], ids=["op12", "op3"])
def test_whole_texts_go_to_workers_in_small_batches(spark, builder):
    """10,000 whole texts a batch before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        builder(spark.createDataFrame([(1, "s", "some text")], "doc_id long, source string, text string"))
        assert int(spark.conf.get(name)) <= 2000
    finally:
        spark.conf.set(name, before)

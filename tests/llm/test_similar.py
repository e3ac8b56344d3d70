"""The near-dedup stage against brute-force Jaccard of 5-word shingles."""

import os
import random
import re

import pytest

from foliary.llm import common, components, simhash, similar

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_kept(texts):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {find(i) for i in range(len(texts))}


def made(n):
    r = random.Random(11)
    vocab = ["".join(r.choices("abcdef", k=r.randint(2, 6))) for _ in range(300)]
    passage = r.choices(vocab, k=30)
    texts = [None, "", " \t", "a", "A b", "a B", "a b c d", "12 34"]
    for _ in range(n):
        base = r.choices(vocab, k=r.choice([6, 40, 90, 150]))
        texts.append(" ".join(base))
        texts.append(" ".join(base + passage))
        for _ in range(r.randint(0, 5)):
            copy = list(base)
            for _ in range(r.randint(1, 4)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            texts.append(" ".join(copy) + r.choice(["", " z", " " + " ".join(r.choices(vocab, k=8))]))
    crowd = r.choices(vocab, k=60)
    for _ in range(150):
        copy = list(crowd)
        copy[r.randrange(60)] = r.choice(vocab)
        copy[r.randrange(60)] = r.choice(vocab)
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("rounds", [2, 0])
def test_near_dedup_stage_is_jaccard(spark, monkeypatch, rounds):
    import corpus_pipeline

    monkeypatch.setattr(similar, "HUB_ROUNDS", rounds)
    texts = made(60)
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n int").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    want = brute_kept(texts)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert 100 < len(want) < len(texts) - 50
    assert similar.keep_first_similar(docs.limit(0)).count() == 0


def test_near_dedup_stage_goes_by_pivots(spark, monkeypatch):
    """What the pivot tables bring together by fingerprints is verified, and the stage starts from it."""
    import corpus_pipeline

    r = random.Random(4)
    vocab = ["".join(r.choices("abcdef", k=r.randint(2, 6))) for _ in range(300)]
    texts = []
    for _ in range(6):
        base = r.choices(vocab, k=1500)
        texts += [" ".join(base), " ".join([*base, "z"]), " ".join(base[:700])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, plain = [], similar.pivot_links

    def watched(*args):
        seen.append(plain(*args))
        return seen[-1]

    monkeypatch.setattr(similar, "pivot_links", watched)
    rows, _ = similar.similar_classes(docs)
    at = {row.fp: row.doc_id for row in rows.collect()}
    assert {tuple(sorted((at[p.a], at[p.b]))) for p in seen[0].collect()} == {(3 * i, 3 * i + 1) for i in range(6)}
    marks = {row.doc_id: row.mark for row in similar.shingled(docs).collect()}
    for i, t in enumerate(texts):
        hashes = [int(h) for h in similar.shingles(t)]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert marks[i] % (1 << 64) == want
    assert sorted(row.doc_id for row in corpus_pipeline.near_dedup(spark, docs, "").collect()) == sorted(brute_kept(texts))
    assert len(seen) == 2


@pytest.mark.parametrize("few", [0, 100_000])
def test_components_of_few_and_of_any_edges(spark, monkeypatch, few):
    """Few edges take no rounds; the rounds, for any number, give the same and leave one table."""
    r = random.Random(5)
    nodes = [r.getrandbits(64) - (1 << 63) for _ in range(120)]
    pairs = [(r.choice(nodes), r.choice(nodes)) for _ in range(60)] + list(zip(nodes[60:], nodes[61:], strict=False)) + [(nodes[0], nodes[0])]
    low = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in low:
        for a, b in pairs:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    made_tables, plain = [], components.stored
    monkeypatch.setattr(components, "FEW_EDGES", few)
    monkeypatch.setattr(components, "stored", lambda df: made_tables.append(plain(df)) or made_tables[-1])
    before = tables(spark)
    got = components.components(spark.createDataFrame(pairs, "a long, b long"))
    assert {x.node: x.root for x in got.collect()} == low
    assert len(tables(spark) - before) == 1
    assert (len(made_tables) > 1) == (few == 0)
    assert components.components(spark.createDataFrame(pairs[-1:], "a long, b long")).count() == 0


def tables(spark):
    return set(os.listdir(common.shared_dir(spark).removeprefix("file:")))


@pytest.mark.parametrize("few", [0, 100_000])
def test_near_dedup_deletes_what_it_has_read(spark, monkeypatch, few):
    """Many partitions make a file of each handful of rows, so tables that nothing reads any more must go at once."""
    texts = made(8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before, most, plain = tables(spark), [0], common.stored

    def counted(df):
        out = plain(df)
        most[0] = max(most[0], len(tables(spark) - before))
        return out

    monkeypatch.setattr(components, "FEW_EDGES", few)
    for module in (common, components, similar, simhash):
        monkeypatch.setattr(module, "stored", counted)
    kept = similar.keep_first_similar(docs)
    assert sorted(row.doc_id for row in kept.collect()) == sorted(brute_kept(texts))
    assert most[0] <= 24
    assert len(tables(spark) - before) <= 16

"""Sharding, mixing, the pipeline and the registered queries."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardstream.llm import mixing as M
from cardstream.llm import queries as R
from cardstream.llm import sharding as S
from llm_cases import EDGE, SF001
from llm_cases import docs, edge, empty, plain  # noqa: F401 (fixtures)


def least_capacity(sizes, shards):
    low, high = 0, sum(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        used, full, ok = 1, 0, max(sizes) <= mid
        for s in sizes:
            if full + s > mid:
                used, full = used + 1, 0
            full += s
        if ok and used <= shards:
            high = mid
        else:
            low = mid
    return high


def check_shards(rows, docs, shards=24):
    texts = [(d, t or "") for d, t in docs]
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in texts if d is not None)
    assert len(rows) == len(docs) and {r.law for r in rows} <= {"bytes"} and all(r.grown_shard is None for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    where = defaultdict(set)
    for r in rows:
        where[r.size, r.text_crc32].add(r.shard)
    assert all(len(v) == 1 for v in where.values())
    # the groups in their order, and the best cut of that order
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    groups = []
    for r in order:
        if groups and groups[-1][0] == (r.size, r.text_crc32):
            groups[-1][1] += r.size
        else:
            groups.append([(r.size, r.text_crc32), r.size])
    most = max(sum(r.size for r in m) for m in by.values())
    assert set(by) <= set(range(shards))
    assert most == least_capacity([g[1] for g in groups], shards)


def test_shards_documents(docs, plain):
    check_shards(S.assign_shards(docs).collect(), [p[:2] for p in plain])


def test_shards_edges(edge, empty):
    check_shards(S.assign_shards(edge).collect(), [e[:2] for e in EDGE])
    check_shards(S.assign_shards(edge, 3).collect(), [e[:2] for e in EDGE], 3)
    assert S.assign_shards(empty).count() == 0


@pytest.mark.parametrize("seed,cells", [(1, 8), (2, 5), (3, 40), (4, 3), (5, 1000)])
def test_coarse_to_fine_is_exact(spark, seed, cells):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 50, 400, rng.randint(1, 2000)]) for _ in range(rng.randint(5, 400))]
    rows, at = [], 0
    for s in sizes:
        rows.append((at, s, True))
        at += s
    df = spark.createDataFrame(rows, "at bigint, size bigint, starts boolean")
    for shards in (1, 3, 24):
        cuts = S.minimax_cuts(df, shards, cells)
        assert cuts[-1] == at and len(cuts) <= shards
        assert max(b - a for a, b in zip([0, *cuts], cuts)) == least_capacity(sizes, shards)


def test_write_shards(spark, docs, tmp_path):
    S.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


def brute_rake(cells, targets, rounds=500):
    w = {k: float(t) for k, t in cells.items()}
    whole = sum(w.values())
    w = {k: v / whole for k, v in w.items()}
    for _ in range(rounds):
        for m in range(3):
            sums = defaultdict(float)
            for k, v in w.items():
                sums[k[m]] += v
            w = {k: v * targets[m].get(k[m], 0.0) / sums[k[m]] if sums[k[m]] else 0.0 for k, v in w.items()}
    return w


def cells_of(rows):
    cells = defaultdict(int)
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    return cells


def brute_top(want, cells, short):
    """Largest weight per token below the steps that together hold at most ``short``."""
    steps = defaultdict(lambda: [0.0, 0.0])
    for k, w in want.items():
        if w > 0:
            s = steps[math.floor(math.log2(w / cells[k]) * M.STEPS)]
            s[0], s[1] = s[0] + w, max(s[1], w / cells[k])
    whole, down_to = sum(w for w, _ in steps.values()), 0.0
    for _, (w, most) in sorted(steps.items(), reverse=True):
        down_to += w
        if down_to > short * whole:
            return most


def check_mixture(rows, targets, short=M.SHORT):
    cells = cells_of(rows)
    want = brute_rake(cells, targets)
    top = brute_top(want, cells, short)
    for r in rows:
        k = r.source, r.lang, r.topic
        assert r.weight == pytest.approx(want[k], rel=1e-3, abs=1e-9)
        assert r.probability == pytest.approx(min(1.0, want[k] / cells[k] / top), rel=1e-3, abs=1e-9)
    # expected tokens meet every marginal
    for m, target in enumerate(targets):
        got = defaultdict(float)
        for r in rows:
            got[(r.source, r.lang, r.topic)[m]] += r.tokens * r.probability
        whole = sum(got.values())
        for v, share in target.items():
            if v in got:
                assert got[v] / whole == pytest.approx(share, abs=1e-4 + short)


def tempered(rows):
    out = []
    for m, name in enumerate(M.MARGINS):
        sums = defaultdict(int)
        for k, t in cells_of(rows).items():
            sums[k[m]] += t
        raw = {v: t ** M.TEMPER[name] for v, t in sums.items()}
        whole = sum(raw.values())
        out.append({v: x / whole for v, x in raw.items()})
    return out


def test_mixture_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.mixture(docs).collect()
    assert len(rows) == docs.count()
    check_mixture(rows, tempered(rows))
    exact = M.mixture(docs, short=0.0).collect()
    check_mixture(exact, tempered(exact), 0.0)
    drawn = sum(r.sampled for r in rows)
    mean = sum(r.probability for r in rows)
    assert abs(drawn - mean) < 5 * np.sqrt(sum(r.probability * (1 - r.probability) for r in rows) + 1)
    again = {r.doc_id: r.sampled for r in M.mixture(docs.repartition(3)).collect()}
    assert again == {r.doc_id: r.sampled for r in rows}


def test_mixture_given_targets(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "x" * rng.randint(10, 400), rng.choice("ab"), rng.choice("pq"), rng.choice("uv"))
                                  for i in range(600)], "doc_id int, text string, lang string, source string, kind string")
    targets = {"source": {"p": 0.8, "q": 0.2}, "lang": {"a": 0.3, "b": 0.7, "absent": 0.0}, "topic": {"u": 0.5, "v": 0.5}}
    rows = M.mixture(docs, topic_col=F.col("kind"), targets=targets).collect()
    check_mixture(rows, [targets["source"], {"a": 0.3, "b": 0.7}, targets["topic"]])


def test_one_stray_source_sets_no_rate(spark):
    """A document of a new source leaves the others' probabilities as they are (nearly)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    stray = spark.createDataFrame([(-1, "a stray text of a few words", "en", "stray")], docs.schema)
    mean = lambda df: df.agg(F.avg("probability")).first()[0]
    before = mean(M.mixture(docs))
    rows = M.mixture(docs.union(stray))
    assert mean(rows) > before - 0.02
    assert rows.where("source = 'stray'").first().probability == 1.0


def test_contradicting_targets_end_with_a_warning(spark):
    """A source alone in its language: both tempered targets cannot be met."""
    docs = spark.createDataFrame([(i, "x" * 400, "zz" if i % 3 == 0 else "en", "hot" if i % 3 == 0 else f"s{i % 2}")
                                  for i in range(300)], "doc_id int, text string, lang string, source string")
    targets = {"source": {"hot": 0.2, "s0": 0.4, "s1": 0.4}, "lang": {"zz": 0.3, "en": 0.7}, "topic": {"note": 1.0}}
    with pytest.warns(UserWarning, match="contradict"):
        rows = M.mixture(docs, targets=targets).collect()
    assert len(rows) == 300 and all(0 < r.probability <= 1 for r in rows)


def test_mixture_edges(edge, empty):
    rows = M.mixture(edge).collect()
    assert len(rows) == len(EDGE) and {r.source for r in rows} == {"(none)", "a", "b"}
    assert M.mixed(edge).columns == edge.columns
    assert M.mixture(empty).count() == 0 and M.mixed(empty).count() == 0


def test_pipeline_stages(spark, docs):
    """Each stage has the columns of documents; the near copies go; the rest is packed whole."""
    now, names = docs, docs.columns
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.written(stage(spark, now, SF001), "t-stage", keep=True)
        assert now.columns == names, name
        seen.append(now.count())
    assert seen[0] > seen[1] > seen[2] == seen[3] >= seen[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF001)
    assert packed.select("doc_id").distinct().count() == now.count()


def test_pipeline_edges(spark, edge, empty):
    for rows in (edge.select(*corpus_pipeline.COLUMNS), empty):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = corpus_pipeline.written(stage(spark, now, ""), "t-edge", keep=True)
            now.count()


def test_sql_of_registered_queries(spark):
    from oracle_compare import compare, duck
    con = duck(SF001)
    for name, sql in R.ORACLE_SQL.items():
        res = compare(R.QUERIES[name](spark, SF001), con, sql, exact=True)
        assert res["ok"], (name, res)


def test_stages_remove_their_own_tables_alone(spark, docs):
    """A frame that a caller holds outlives a pipeline; a stage's tables go with the next stage."""
    from cardstream.llm import quality_rules
    from cardstream.llm.common import written
    held = quality_rules.quality_rules(docs)
    kept = written(corpus_pipeline.quality(spark, docs, "x"), "t-kept")
    made = list(corpus_pipeline._MADE[corpus_pipeline.get_ident(), "x"])
    corpus_pipeline.near_duplicates(spark, kept, "y")           # another run
    assert made and corpus_pipeline._MADE[corpus_pipeline.get_ident(), "x"] == made
    corpus_pipeline.near_duplicates(spark, kept, "x")
    assert not set(made) & set(corpus_pipeline._MADE[corpus_pipeline.get_ident(), "x"])
    assert held.count() == docs.count()

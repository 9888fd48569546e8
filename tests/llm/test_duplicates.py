"""SimHash near-duplicates, repeated passages, Order MinHash."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardstream.llm import order_minhash as O
from cardstream.llm import simhash as H
from cardstream.llm import suffix_dedup as S
from llm_cases import DOC_DDL, EDGE, PROSE
from llm_cases import docs, edge, empty, plain  # noqa: F401 (fixtures)

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- SimHash

def brute_fingerprint(text):
    words = WORD.findall((text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Component number of each fingerprint of a list."""
    left, comp = set(range(len(fps))), {}
    while left:
        root = min(left)
        front = [root]
        left.discard(root)
        while front:
            i = front.pop()
            comp[i] = root
            near = [j for j in left if (fps[i] ^ fps[j]).bit_count() <= 4]
            left.difference_update(near)
            front += near
    return comp


def brute_simhash(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[comp[i]] = min(least.get(comp[i], doc_id), doc_id)
    return sorted(((d, f"{fps[i]:016x}", least.get(comp[i])) for i, (d, _) in enumerate(rows)), key=str)


def simhash(docs):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in H.simhash_components(docs).collect()), key=str)


def test_simhash_documents(docs, plain):
    assert simhash(docs) == brute_simhash([p[:2] for p in plain])


def test_simhash_edges(edge, empty):
    assert simhash(edge) == brute_simhash([e[:2] for e in EDGE])
    assert simhash(empty) == []


def test_near_duplicates_keep_one(spark, docs, plain, edge, empty):
    want = {c for _, _, c in brute_simhash([p[:2] for p in plain])}
    kept = H.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    out = H.near_duplicates_removed(edge)
    assert out.columns == edge.columns
    ids = [r.doc_id for r in out.collect()]
    groups = {i: c for i, (_, _, c) in enumerate(brute_simhash([e[:2] for e in EDGE]))}
    assert len(ids) == len(set(ids)) == len(set(groups.values()))
    assert H.near_duplicates_removed(empty).count() == 0


def close_fingerprints(n, seed):
    """Chains and clusters of fingerprints a few bits apart, in part sharing their low half."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    low = rng.getrandbits(32)
    out += [rng.getrandbits(32) << 32 | low for _ in range(n // 4)]
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("chosen", [
    [(list(range(0, 16)), 0), (list(range(16, 32)), 0), (list(range(32, 48)), 1), (list(range(48, 64)), 0)],
    [(list(range(0, 20)), 2), (list(range(20, 42)), 0), (list(range(42, 64)), 0)],
    [(list(range(k, 64, 5)), 0) for k in range(5)], None])
def test_links_connect_what_is_near(spark, chosen):
    """Thresholds of any plan, and files far beyond a block."""
    fps = close_fingerprints(1200, 5)
    signed = np.array(fps, np.uint64).view(np.int64)
    nodes = spark.createDataFrame([(int(x),) for x in signed], "fp bigint")
    if chosen is None:
        chosen = H.plan(signed, 10**9)
    links = H.links(nodes, chosen, block=64)
    pairs = [(r.a, r.b) for r in links.collect()]
    got = {r.node: r.root for r in H.components(links).collect()}
    comp = brute_components(fps)
    size = Counter(comp.values())
    want = Counter()
    for i, x in enumerate(signed.tolist()):
        if size[comp[i]] > 1:
            want[comp[i], got[x]] += 1
        else:
            assert x not in got
    assert len(want) == len({a for a, _ in want}) == len({b for _, b in want})
    assert len(pairs) < 40 * len(fps)


def test_plan_obeys_the_pigeonhole_sum():
    sample = np.array(close_fingerprints(400, 1), np.uint64).view(np.int64)
    for total in (10**3, 10**6, 10**9):
        chosen = H.plan(sample, total)
        bits = [b for g, _ in chosen for b in g]
        assert len(bits) == len(set(bits))
    costs = [{-1: 0.0, 0: 5.0, 1: 6.0}, {-1: 0.0, 0: 1.0, 1: 100.0}, {-1: 0.5, 0: 2.0, 1: 3.0, 2: 9.0}]
    for budget in range(-3, 4):
        tried = [sum(c[t] for c, t in zip(costs, ts)) for ts in itertools.product(*costs) if sum(ts) == budget]
        cost, ts = H.allocate(costs, budget)
        assert cost == min(tried) and sum(ts) == budget and cost == sum(c[t] for c, t in zip(costs, ts))
    groups = H.group_bits(sample, 5)
    assert sorted(b for g in groups for b in g) == list(range(64))


# ---------------------------------------------------------------- repeated passages

def brute_repeats(texts, length=200):
    """Per text: (bytes, removed, runs, digest)."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        kept = bytes(c for c, x in zip(t, cover) if not x)
        runs = len(re.findall(rb"\x01+", bytes(cover)))
        out.append((len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


def digests(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.repeat_digest(docs).collect()), key=str)


def test_repeats_documents(docs, plain):
    want = brute_repeats([(p[1] or "").encode() for p in plain])
    assert digests(docs) == sorted(((p[0], *w) for p, w in zip(plain, want)), key=str)


def test_repeats_edges(edge, empty):
    want = brute_repeats([(e[1] or "").encode() for e in EDGE])
    assert digests(edge) == sorted(((e[0], *w) for e, w in zip(EDGE, want)), key=str)
    assert digests(empty) == []
    out = S.repeats_removed(edge)
    assert out.columns == edge.columns and out.count() == len(EDGE)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[4] == "" and texts[11 * -1] == "one"
    assert S.repeats_removed(empty).count() == 0


def passages(seed, n, small=False):
    """Random texts that share passages of all lengths around the limit, nested and overlapping."""
    rng = random.Random(seed)
    letters = "ab" if small else "abcdefghij "
    text = lambda k: "".join(rng.choice(letters) for _ in range(k))
    pool = [text(rng.choice([30, 60, 90, 150, 199, 200, 201, 260, 500])) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts += [text(rng.randint(0, 40)), p if rng.random() < 0.5 else p[a:]]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("seed,n,group", [(1, 40, 2048), (2, 60, 4), (3, 30, 2), (4, 120, 8)])
def test_repeats_of_nested_passages(spark, seed, n, group):
    """Small groups force the split of an anchor's file, level by level."""
    texts = passages(seed, n)
    keyed = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "uid bigint, text binary")
    spans = {}
    for r in S.repeats(keyed, group=group).collect():
        spans.setdefault(r.uid, []).append((r.start, r.stop))
    for i, (t, want) in enumerate(zip(texts, brute_repeats([t.encode() for t in texts]))):
        runs = S.merged(spans.get(i, []))
        kept = S._cut(t.encode(), runs)
        assert (len(t), len(t) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()) == want


def test_repeat_groups_hold_all_occurrences(spark):
    shared = PROSE * 2
    texts = [f"{i} {shared} {i * 7}" for i in range(5)]
    keyed = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "uid bigint, text binary")
    groups = {}
    for r in S.repeats(keyed).collect():
        groups.setdefault(r.repeat, set()).add(r.uid)
    assert any(g == set(range(5)) for g in groups.values())


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 1000)
    rng = random.Random(3)
    text = bytes(rng.choices(b"abcdef", k=5000))
    rows = set()
    for numbers, offsets, parts in S._pieces([text, text[:300]], 200):
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        part, pos, lo, hi, h, g = S.anchors(np.frombuffer(b"".join(parts), np.uint8), bounds)
        for a, p, x, y in zip(part, pos, lo, hi):
            at = p + offsets[a]
            for d in range(x, y + 1):
                assert (numbers[a], at - d) not in rows
                rows.add((numbers[a], at - d))
    assert rows == {(0, i) for i in range(4801)} | {(1, i) for i in range(101)}


def test_intervals_against_all_pairs():
    rng = random.Random(2)
    for _ in range(50):
        words = sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(2, 12)))
        lcp = [S._common(a.encode(), b.encode()) for a, b in zip(words, words[1:])]
        want = set()
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                d = min(lcp[i:j])
                if (i == 0 or lcp[i - 1] < d) and (j == len(lcp) or lcp[j] < d):
                    want.add((d, i, j))
        assert set(S.intervals(lcp)) == want


def test_whole_characters():
    text = "aéb日c".encode()
    assert S.whole_characters(text, [(2, 5)]) == [(3, 4)]
    assert S.whole_characters(text, [(1, 3), (4, 7)]) == [(1, 3), (4, 7)]


# ---------------------------------------------------------------- Order MinHash

def brute_omh(spark, texts):
    """The selection and order by loops; only the hashes come from Spark."""
    rows, grams = [], set()
    for t in texts:
        words = [w.decode() for w in WORD.findall((t or "").encode())]
        ks = [tuple(words[i:i + O.K]) for i in range(max(1, len(words) - O.K + 1))] if words else []
        rows.append(ks)
        grams |= set(ks)
    grams = sorted(grams)
    h = {}
    if grams:
        df = spark.createDataFrame([(i, list(g)) for i, g in enumerate(grams)], "i int, g array<string>")
        h = {grams[r.i]: r.h for r in df.select("i", F.xxhash64("g").alias("h")).collect()}
    pairs = sorted({(h[k], c) for ks in rows for k, n in Counter(ks).items() for c in range(n)})
    r = {}
    if pairs:
        df = spark.createDataFrame(pairs, "h bigint, c int")
        r = {(x.h, x.c): x.r for x in df.select("h", "c", F.xxhash64("h", "c").alias("r")).collect()}
    chosen = []
    for ks in rows:
        seen, ranked = Counter(), []
        for pos, k in enumerate(ks):
            ranked.append(((r[h[k], seen[k]] % 2**64) >> 32, pos, h[k]))
            seen[k] += 1
        sketches = {}
        for j in range(O.SKETCHES if ks else 0):          # each with the hash turned by its part of the range
            own = sorted(ranked, key=lambda x: ((x[0] - j * 2**32 // O.SKETCHES) % 2**32, x[1]))[:O.TUPLE]
            sketches[j] = [x[2] for x in sorted(own, key=lambda x: x[1])]
        chosen.append(sketches)
    flat = sorted({tuple(v) for c in chosen for v in c.values()})
    made = {}
    if flat:
        df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(flat)], "i int, v array<bigint>")
        made = {flat[x.i]: x.t for x in df.select("i", F.xxhash64("v").alias("t")).collect()}
    return [[made[tuple(c[b])] if b in c else 0 for b in range(O.SKETCHES)] for c in chosen]


def brute_edits(rows):
    """Edited text and the next document's row, by a plain sort. Fully repeated rows are one."""
    distinct = sorted({(d if d is not None else -(1 << 63), t or "") for d, t in rows}, reverse=True)
    return distinct


def near(a, b):
    filled = [(x, y) for x, y in zip(a, b) if x or y]
    return 1.0 if not filled else sum(x == y for x, y in filled) / len(filled)


def check_omh(spark, rows, got):
    order = brute_edits(rows)
    # equal ids are ordered by a hash of the text; take that order as given and check the rest
    assert len({d for d, _ in order}) == len(order)
    nxt = {order[i]: order[(i + 1) % len(order)] for i in range(len(order))}
    edited = {}
    for key in order:
        t, other = key[1], nxt[key][1]
        half = len(t) // 2
        edited[key] = t[:len(t) - half] + other[:half]
    prints = dict(zip(order, brute_omh(spark, [k[1] for k in order])))
    eprints = dict(zip(order, brute_omh(spark, [edited[k] for k in order])))
    text = lambda fp: "".join(f"{x % 2**64:016x}" for x in fp)
    want = []
    for d, t in rows:
        key = (d if d is not None else -(1 << 63), t or "")
        want.append((d, len(key[1]), hashlib.sha256(edited[key].encode()).hexdigest(), text(prints[key]), text(eprints[key]),
                     near(prints[key], eprints[key]), near(prints[key], prints[nxt[key]])))
    assert sorted(got, key=str) == sorted(want, key=str)


def omh(docs):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in O.edit_fingerprints(docs).collect()]


def test_order_minhash_documents(spark, docs, plain):
    check_omh(spark, [p[:2] for p in plain], omh(docs))


def test_order_minhash_edges(spark, edge, empty):
    rows = [e[:2] for e in EDGE]
    check_omh(spark, rows, omh(edge))
    assert omh(empty) == []
    one = spark.createDataFrame([(5, "a b c a b c a b c", None, None, 0)], DOC_DDL)
    check_omh(spark, [(5, "a b c a b c a b c")], omh(one))


def test_order_minhash_feels_order(spark):
    """Moving a block keeps every k-mer but one or two, and still changes tuples."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    moved = words[200:] + words[:200]
    df = spark.createDataFrame([(" ".join(words), " ".join(moved), " ".join(words[:390]))], "a string, b string, c string")
    df = O.with_fingerprint(O.with_fingerprint(O.with_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb"), F.col("c"), "fc")
    r = df.select(O.likeness(F.col("fa"), F.col("fb")).alias("moved"), O.likeness(F.col("fa"), F.col("fc")).alias("cut")).first()
    assert r.moved < r.cut and r.cut >= 0.7


@pytest.mark.parametrize("n", [40, 100, 400])
def test_order_minhash_of_swapped_halves(spark, n):
    """The mean is the method's own value at every length: both k-mers of a tuple stem from one half, whose
    (n - 4) / 2 k-mers stay, out of the n that the two texts have."""
    rng = random.Random(n)
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for _ in range(200)]
    df = spark.createDataFrame([(" ".join(t), " ".join(t[n // 2:] + t[:n // 2])) for t in texts], "a string, b string")
    df = O.with_fingerprint(O.with_fingerprint(df, F.col("a"), "fa"), F.col("b"), "fb")
    exact = (n - 4) * (n - 6) / (2 * n * (n - 1))        # 0.39, 0.46, 0.49
    assert abs(df.select(F.avg(O.likeness(F.col("fa"), F.col("fb")))).first()[0] - exact) <= 0.02


def test_order_minhash_finds_half_copies(spark, tmp_path):
    """The registered query: every text of 100 words or more is nearer to its half-copy than to an unrelated text."""
    from cardstream.llm.queries import op8_order_minhash
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{rng.randrange(10**5):05d}" for _ in range(rng.randrange(100, 200))), "en", "a", 0)
            for i in range(400)]
    spark.createDataFrame(rows, DOC_DDL).write.parquet(str(tmp_path / "documents.parquet"))
    got = op8_order_minhash(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got if r.near_edited <= r.near_next] == []


def test_order_minhash_keeps_every_position(spark):
    """No position an array can have is clamped: each k-mer is looked up by its own."""
    at = [0, 2**24 - 1, 2**24, 2**24 + 1, 2**31 - 2]
    rows = spark.createDataFrame([(h, i) for h in (-1, 0, 2**63 - 1) for i in at], "h bigint, i int")
    numbers = rows.select("h", "i", O.packed(F.col("h"), F.col("i")).alias("n"))
    got = numbers.select("h", "i", "n", O.place(F.col("n")).alias("p")).collect()
    assert all(r.p == r.i and r.n >= 0 for r in got)
    assert [(r.h % 2**64, r.i) for r in sorted(got, key=lambda r: r.n)] == sorted((r.h % 2**64, r.i) for r in got)

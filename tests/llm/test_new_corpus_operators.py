"""Target resampling, chat formatting and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from cardstream.llm import chat as C
from cardstream.llm import queries as R
from cardstream.llm import resampling as T
from cardstream.llm import spelling as P
from cardstream.llm.common import pieces
from llm_cases import PROSE, SF001
from llm_cases import docs, edge, empty, plain  # noqa: F401 (fixtures)
from oracle_compare import compare, duck

BYTES = public_tokenizers.path("byte_bpe_50k.json")
CONV_DDL = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("name", ["op11_target_resampling", "op12_chat_format", "op13_spelling_variants"])
def test_queries_equal_their_sql(spark, name):
    got = compare(R.QUERIES[name](spark, SF001), duck(SF001), R.ORACLE_SQL[name])
    assert got["ok"] and got["rows_spark"] > 0, got


# --- target resampling ---

def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_resample(docs, target, share=10, run=1, min_words=20):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return words, [" ".join(words[i: i + k]) for k in range(1, run + 1) for i in range(len(words) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t_ = Counter(bucket(f) for t in target for f in features(t)[1])
    S, T_ = sum(s.values()), sum(t_.values())
    out = []
    for d, text in docs:
        words, found = features(text)
        weight = sum(math.floor(1000 * math.log((t_[b] + 1) * (S + 10000) / ((s[b] + 1) * (T_ + 10000))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: share * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


@pytest.mark.parametrize("run,share", [(1, 10), (2, 35), (3, 100)])
def test_resampling_equals_brute_force(spark, edge, docs, plain, run, share):
    target = spark.read.parquet(f"{SF001}/benchmark.parquet")
    both = docs.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    rows = [tuple(r) for r in both.collect()]
    got = T.resample(both, target, share=share, run=run).collect()
    assert sorted(map(tuple, got), key=repr) == brute_resample(
        rows, [r.text for r in target.collect()], share, run)


def test_resampling_edges(spark, edge, empty):
    assert T.resample(empty, empty).collect() == []
    drawn = T.resample(edge, empty, share=100)              # other columns clash and are not read
    assert drawn.columns == T.RESULT and drawn.count() == edge.count()
    long = "Word7 ünd " * 400_000                            # 4 MB: several pieces
    frame = spark.createDataFrame([(1, long), (2, "Word7 ünd " * 10)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in T.resample(frame, frame.where("doc_id = 2"), share=100, run=2).collect()}
    assert got[1].n_words == 800_000 and got[1].n_features == 1_599_999


def test_pieces_lose_nothing():
    text = b"one two  three " * 50 + b"x" * 99
    cut = list(pieces(text, b" ", 20))
    assert b"".join(cut) == text and len(cut) > 10 and all(p.endswith(b" ") for p in cut[:-1])
    assert list(pieces(b"", b" ")) == [b""] and list(pieces(b"y" * 50, b" ", 20)) == [b"y" * 50]


@pytest.mark.parametrize("n,scores", [(1, 1), (400, 1), (400, 3), (1000, 500)])
def test_quickselect_finds_every_rank(spark, n, scores):
    rng = random.Random(n + scores)
    rows = [(rng.randrange(scores), rng.choice([None, *range(20)]), k) for k in range(n)]
    keys = spark.createDataFrame(rows, "score bigint, doc_id bigint, row bigint").repartition(4).cache()
    order = sorted(rows, key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2]))
    for k in {1, 2, n // 3, n // 2, n - 1, n} & set(range(1, n + 1)):
        assert T.kth_key(keys, k) == order[k - 1]
    assert T.kth_key(keys, 0) is None and T.kth_key(keys, n + 1) is None
    keys.unpersist()


# --- chat formatting ---

CASES = [
    (1, 0, "system", "Be brief. <<SYS>> <<\\SYS>>"), (1, 1, "user", "</s>[INST] [\\INST] <s><\\\\s>"),
    (1, 2, "assistant", "[/TURN]\\[ROLE] ok <|endoftext|>\n"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 7, "assistant", "first"), (2, 7, "assistant", "second"), (2, 7, "user", "tie"), (2, None, "user", "no turn"),
    (2, 9, "tool", "42"), (2, 10, None, "no role"), (2, 11, "[ROLE]", "x"), (2, 12, "", " "),
    (None, 0, "user", "日本 é \U0001f600"), (None, 1, "assistant", " ok "), (None, 1, "assistant", " ok "),
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def text_key(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", xxhash.xxh64_intdigest((r[3] or "").encode(), 42) ^ 1 << 63)


def brute_chat(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = []
    for conv, turns in by.items():
        text, loss, formatted = "", "", ""
        for _, _, role, t in sorted(turns, key=text_key):
            role, t = role or "", t or ""
            text += f"{role}\n{t}\n"
            loss += t if role == "assistant" else ""
            e = C.escape(t)
            formatted += {"user": f"[INST]{e}[/INST]", "assistant": f"{e}</s>", "system": f"<<SYS>>{e}<</SYS>>"}.get(
                role, f"[ROLE]{C.escape(role)}[/ROLE]{e}[/TURN]")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha(text), len(loss), sha(loss), len(formatted)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_chat_equals_brute_force(spark, partitions):
    long = [(50, k, ("user", "assistant")[k % 2], f"turn {k} [INST]") for k in range(900)]      # cut by ranges
    rows = CASES + long
    frame = spark.createDataFrame(rows, CONV_DDL).withColumn("ids", F.lit("clash"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, C.digests(frame, BYTES).collect()), key=repr) == brute_chat(rows)
        turns = C.format_conversations(frame, BYTES).where("conv_id = 50").orderBy("start").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    at = 0
    for k, t in enumerate(turns):                       # places follow on each other over all ranges
        assert t.turn == k and t.start == at
        at += len(t.ids)
        assert sum(t.loss) == (len(t.ids) - 1 if k % 2 else 0) and t.loss[-1] == 0
    assert C.digests(spark.createDataFrame([], CONV_DDL), BYTES).collect() == []


def test_escaping_is_reversible():
    rng = random.Random(5)
    parts = [*C.CONTROLS, "\\", "[", "<", "/", "INST]", "s>", "SYS>>", "a", " ", "</", "<<"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randrange(8)))
        safe = C.escape(text)
        assert C.unescape(safe) == text and not any(c in safe for c in C.CONTROLS)


def test_long_texts_are_encoded_as_whole_ones(monkeypatch):
    encoder = C.Encoder(BYTES)
    text = (PROSE + "naïve 12 (x) don't  two\n\n three\t") * 30
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(C, "PIECE", 100)
    assert encoder.encode([text, "", "a b"])[0].tolist() == whole
    with pytest.raises(ValueError):
        C.Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_a_mask_lies_on_learned_texts_alone():
    encoder = C.Encoder(BYTES)
    ids, loss, ends = C.splice(encoder, ["user", "assistant", "x", "assistant"], ["q", "an answer", "y", ""])
    assert encoder.tokenizer.decode(ids[loss == 1].tolist()) == "an answer"
    assert [int(ids[e - 1]) for e in ends] == [encoder.ids[c] for c in ("[/INST]", "</s>", "[/TURN]", "</s>")]
    assert len(loss) == len(ids) == ends[-1] and not loss[ids >= encoder.base].any()


# --- spelling variants ---

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(docs):
    n = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    form, near = {}, {}
    for w in words:
        others = [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], near[w], words.get(form[w])))
    return sorted(out, key=repr)


def test_scan_finds_all_pairs():
    rng = random.Random(3)
    for alphabet, longest, count in (("ab", 7, 90), ("abé", 5, 150), ("abcdefgh", 3, 200), ("a", 9, 9)):
        words = sorted({"".join(rng.choices(alphabet, k=rng.randrange(longest + 1))) for _ in range(count)})
        want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}
        assert set(P.scan(words)) == want
    assert list(P.scan([])) == list(P.scan(["a"])) == []


@pytest.mark.parametrize("block", [2, 8, 10_000])
def test_spelling_equals_brute_force(spark, block):
    rng = random.Random(9)
    stems = ["aaaaaaaa", "aaaaaabb", "spelling", "spellings", "colour", "coloür", "abcabcabc"]
    texts = []
    for d in range(40):
        words = []
        for _ in range(150):
            w = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w[k: k + rng.randrange(2)] = rng.choice(["", "a", "b", "ü", "É"])
            words.append("".join(w))
        texts.append((rng.choice([None, d, d]), " ".join(words) + "."))
    texts.append((99, "chained " * 400 + "chainex " * 50 + "chaynex " * 7))          # a chain of forms
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("word", F.lit("clash"))
    got = P.variants(frame, block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_spelling(texts)
    assert len(want) > 50 and sum(r[4] for r in want) > 100 and any(r[2] not in (r[0], r[1]) for r in want)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_spelling_edges(spark, edge, empty):
    assert P.variants(empty).collect() == []
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert sorted(map(tuple, P.variants(edge).collect()), key=repr) == brute_spelling(rows)
    long = "Wörter! spelling spellings\n" * 60_000 + "z" * 2_000_000            # several pieces
    found = Counter(w for runs in P.text_runs(long.encode()) for w in runs)
    assert found == Counter({"wörter": 60_000, "spelling": 60_000, "spellings": 60_000, "z" * 2_000_000: 1})
    assert np.sum([len(b) for b in P.text_runs(b"")]) == 0

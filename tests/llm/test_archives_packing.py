"""WARC round trips and packing."""

import base64
import gzip
import hashlib
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cardstream.llm import packing as P
from cardstream.llm import warc as W
from cardstream.llm.queries import tokenizer_path
from cardstream.session import scratch_path
from llm_cases import EDGE, SF001
from llm_cases import docs, edge, empty, plain  # noqa: F401 (fixtures)


def brute_pages(pages):
    groups = defaultdict(list)
    for page_id, html in pages:
        groups[html or ""].append(page_id)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        last = max((i for i in ids if i is not None), default=None)
        for i in ids:
            out.append((i, len(raw), digest, "response" if i == last else "revisit", None if i == last else last))
    return sorted(out, key=str)


def read(pages):
    rows = W.pages_through_archives(pages).collect()
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


def test_warc_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    assert read(pages) == brute_pages([(r.page_id, r.html) for r in pages.collect()])


def test_warc_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "a\r\nb", "WARC/1.1\r\n\r\nx\r\n\r\n"), (4, "u", "é\x00日\n"),
            (5, "u", "é\x00日\n"), (5, "u", "é\x00日\n"), (None, "u", "é\x00日\n"), (None, "u", "alone"), (7, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")
    assert read(pages) == brute_pages([(r[0], r[2]) for r in rows])
    assert read(pages.limit(0)) == []


def test_files_are_closed_by_bytes(spark):
    """Whatever the pages' sizes, a file holds ``file_bytes`` of payload at most, or one record."""
    sizes = [10] * 300 + [900] * 300 + [20_000] * 40 + [300_000] * 3
    pages = spark.createDataFrame([(i, "u", f"{i}:" + "z" * n) for i, n in enumerate(sizes)],
                                  "page_id bigint, url string, html string").coalesce(1)
    first, limit = scratch_path(spark, "t-mono"), 200_000
    W.write_monolithic(pages, first, limit)
    seen = 0
    for r in spark.read.format("binaryFile").load(first).where("length > 0").collect():
        found = list(W.records(W.inflate(bytes(r.content))))
        seen += len(found)
        assert len(found) == 1 or sum(W.read_record(x)["payload_bytes"] for x in found) <= limit
    assert seen == len(sizes)


def test_normalised_members_and_index(spark, monkeypatch):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    first, second = scratch_path(spark, "t-mono"), scratch_path(spark, "t-warc")
    W.write_monolithic(pages, first)
    W.normalise(spark, first, second)
    plain = {r.path.rsplit("/", 1)[-1].split(".")[0]: r.content
             for r in spark.read.format("binaryFile").load(first).where("length > 0").collect()}
    files = spark.read.format("binaryFile").load(second).where("kind = 'warc'").collect()
    archives = {r.archive: bytes(r.content) for r in files}
    whole = {k: gzip.decompress(bytes(v)) for k, v in plain.items()}
    # a gzip reader sees the same bytes before and after
    assert sorted(gzip.decompress(v) for v in archives.values()) == sorted(v for v in whole.values() if v)
    index = W.read_index(spark, second).collect()
    assert len(index) == pages.count()
    for e in index:
        member = archives[e.archive][e.offset: e.offset + e.length]
        record = gzip.decompress(member)
        assert W.field(record.partition(b"\r\n\r\n")[0], b"warc-record-id").decode() == e.id
        assert [r for r in W.records(iter([record]))] == [record]


@given(st.lists(st.binary(max_size=300), max_size=6), st.integers(1, 64))
@settings(max_examples=60, deadline=None)
def test_records_from_any_pieces(bodies, step):
    made = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in bodies]
    stream = gzip.compress(b"".join(made[:3])) + b"\0\0" + gzip.compress(b"".join(made[3:]))
    assert list(W.records(W.inflate(stream, step))) == made


def check_packing(rows, texts):
    """Every id once, offsets gapless, sequences full."""
    words = P.WordIds(tokenizer_path())
    full = defaultdict(list)
    for doc_id, text in texts:
        ids = words.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        full[doc_id].append(np.array(ids, "<u4"))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc_id, copies in full.items():
        assert len({len(c) for c in copies}) == 1
        ids, covered = copies[0], np.zeros(len(copies[0]), int)
        for r in pieces[doc_id]:
            assert r.doc_tokens == len(ids) and r.length > 0
            covered[r.start: r.start + r.length] += 1
            assert zlib.crc32(ids[r.start: r.start + r.length].tobytes()) == r.ids_crc32
        assert (covered == len(copies)).all()
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
    for members in seqs.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096 and members[0].padded == (at if at & (at - 1) == 0 else 4096)
    return sum(m[0].padded for m in seqs.values()), sum(r.length for r in rows)


def test_packing_documents(spark, docs, plain):
    padded, used = check_packing(P.pack_documents(docs, tokenizer_path()).collect(), [(p[0], p[1]) for p in plain])
    assert padded == used


def test_packing_edges(spark, edge, empty):
    rows = P.pack_documents(edge, tokenizer_path()).collect()
    check_packing([r for r in rows if r.doc_id is not None], [(e[0], e[1]) for e in EDGE if e[0] is not None])
    assert P.pack_documents(empty, tokenizer_path()).count() == 0


@given(st.text(alphabet="aAbHTZ '\n\t\x0b\x0ć̱éÉßİΣσK½²_-<|>1  \u0085\x1c日ⅷ", max_size=20))
@settings(max_examples=300, deadline=None)
def test_remembered_words_give_the_tokenizers_ids(text):
    words = _WORDS
    assert words.ids(text.encode()).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


_WORDS = P.WordIds(tokenizer_path())


def test_special_token_strings():
    for text in ("<|endoftext|> x", "a<|startoftext|>B <|ENDOFTEXT|>"):
        assert _WORDS.ids(text.encode()).tolist() == _WORDS.tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 4095), min_size=1, max_size=60))
@settings(max_examples=60, deadline=None)
def test_pack_fills_everything(lengths):
    total = sum(lengths)
    room = [4096] * (total // 4096) + P.powers_of_two(total % 4096)
    filled, over = P.pack([(i, 0, np.zeros(n, np.uint32)) for i, n in enumerate(lengths)], room)
    assert not over
    assert [sum(len(p[2]) for p in f) for f in filled] == room


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = rng.integers(50, 2000, size=2000)
    k = int(lengths.sum()) // 4096
    filled, _ = P.pack([(i, 0, np.zeros(n, np.uint32)) for i, n in enumerate(lengths)], [4096] * k)
    costs = [sum(P.cost(len(p[2])) for p in f) for f in filled]
    naive = [sum(P.cost(n) for n in lengths[i::k]) for i in range(k)]
    assert np.std(costs) < 0.5 * np.std(naive)

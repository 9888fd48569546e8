"""Quality rules, language identification, licence scan."""

import math
import re
import time
import zlib
from collections import Counter

import pytest

from cardstream.llm import language_id as L
from cardstream.llm import licenses as C
from cardstream.llm import quality_rules as Q
from llm_cases import EDGE
from llm_cases import docs, edge, empty, plain  # noqa: F401 (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {p for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


def test_quality_counts(spark, docs, plain):
    got = {r.doc_id: r for r in Q.quality_rules(docs).collect()}
    assert len(got) == len(plain)
    for doc_id, text, *_ in plain:
        r, want = got[doc_id], brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))
    both = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("quality", "kept", "base_failed").collect()
    good = [r for r in both if r.quality == 1 and not r.base_failed]
    bad = [r for r in both if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_quality_many_repeats_renumber():
    words = [b"w%d" % (i % 30_000) for i in range(90_000)]
    assert Q._repeat_words(words) == 90_000


def test_quality_edges(spark, edge, empty):
    rows = Q.quality_rules(edge).collect()
    assert len(rows) == len(EDGE)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words == 0)
    assert Q.quality_rules(empty).count() == 0
    kept = Q.quality_filter(edge)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r.kept for r in rows)
    assert Q.quality_filter(empty).count() == 0


def test_sketches_merge(spark, docs):
    """A group's sketch equals the sum of its halves' sketches."""
    counts = Q.quality_counts(docs.select("lang", "source", Q.text_bytes().alias("text")))
    from pyspark.sql import functions as F
    whole = Q.sketches(counts).collect()
    halves = Q.sketches(counts.where("n_words % 2 = 0")).unionByName(Q.sketches(counts.where("n_words % 2 = 1")))
    merged = halves.groupBy("lang", "source", "level", "ratio", "bucket").agg(F.sum("n").alias("n")).collect()
    assert sorted(map(str, whole)) == sorted(map(str, merged))


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_language_edges(spark, edge, empty):
    rows = L.language_id(edge).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows}
    assert {by[k].lang_pred for k in (1, 2, 3, 9)} == {"und"}
    assert L.language_id(empty).count() == 0


def test_backoff_prefers_words_then_long_grams(spark):
    sample = spark.createDataFrame([("xx", bytearray(b"alpha beta alpha")), ("yy", bytearray(b"gamma delta"))], "lang string, text binary")
    model = L.Model.fit(sample)
    assert model.score("alpha")[0] == "xx" and model.score("gammas")[0] == "yy"
    assert model.score("alphabet")[0] == "xx"          # unseen: its four-grams
    assert model.score("123") == ("und", 0.0)


def brute_languages(train, texts, entries):
    """The model as plain counts, and each text scored word by word."""
    orders = (0, *L.ORDERS)
    parts = lambda word, o: [word] if o == 0 else L.grams_of(word, o)
    counts = {}
    for lang, text in train:
        for word in L.LETTERS.findall(text.lower()):
            for o in orders:
                counts.setdefault((lang, o), Counter()).update(parts(word, o))
    langs = sorted({lang for lang, _ in counts})
    known = {o: {g for lang in langs for g, _ in sorted(
        counts[lang, o].items(), key=lambda x: (-x[1], x[0]))[:entries]} for o in orders}
    log = lambda g, o: [math.log((counts[lang, o][g] + L.SMOOTH) / (
        sum(counts[lang, o].values()) + L.SMOOTH * (len(known[o]) + 1))) for lang in langs]
    scores = {}

    def word_score(word):
        for o in orders:
            hit = [log(g, o) for g in parts(word, o) if g in known[o]]
            if hit:
                return [sum(x) / len(hit) for x in zip(*hit)]

    out = []
    for text in texts:
        words = L.LETTERS.findall((text or "").lower())
        rows = [scores[w] if w in scores else scores.setdefault(w, word_score(w)) for w in words]
        rows = [r for r in rows if r]
        if not rows:
            out.append(("und" if not words else langs[0], 0.0))
            continue
        mean = [sum(x) / len(rows) for x in zip(*rows)]
        best = max(mean)
        out.append((langs[mean.index(best)], 1 / sum(math.exp(x - best) for x in mean)))
    return out


@pytest.mark.parametrize("entries", [L.MAX_ENTRIES, 40])
def test_language_equals_brute_force(spark, docs, plain, edge, entries):
    """At the registered size, and with so few grams that words fall back through every length."""
    from pyspark.sql import functions as F
    model = L.Model.fit(L.training_sample(docs), entries)
    train = [(lang, text or "") for doc_id, text, lang, _ in plain
             if lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2]
    for frame, rows in ((docs, [p[:2] for p in plain]), (edge, [e[:2] for e in EDGE])):
        got = L.identify(frame.select("doc_id", L.text_bytes().alias("text"), F.col("text").alias("t")), model).collect()
        want = dict(zip((t or "" for _, t in rows), brute_languages(train, [t for _, t in rows], entries)))
        assert len(got) == len(rows)
        for r in got:
            lang, score = want[r.t or ""]
            assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9)


def test_every_language_keeps_its_own_grams(spark):
    """The grams that a language keeps do not depend on how many others there are."""
    rows = [(f"l{i:02d}", f"only{chr(97 + i // 5)}{chr(97 + i % 5)} {chr(107 + i // 5)}{chr(107 + i % 5)}word".encode())
            for i in range(25)]
    df = spark.createDataFrame([(a, bytearray(b)) for a, b in rows], "lang string, text binary")
    model = L.Model.fit(df, 2)
    assert len(model.grams[0].index) == 50
    assert [model.score(b.decode())[0] for _, b in rows] == [a for a, _ in rows]


def brute_licenses(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in C.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base(spark, plain, docs):
    got = {r.doc_id: r for r in C.license_scan(docs).collect()}
    for doc_id, text, *_ in plain:
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_licenses(text)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("text", [
    "cc by nc cc by nc under the MIT-License, under\nthe mit license!", "cc by-nc apache license, version 2.0 cc BY nc",
    "under the mit licenses", "ünder the mit license", "x" * 50, "", "apache license version 2"])
def test_license_phrases(text):
    r = C.scan(text.encode())
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licenses(text)


def test_expressions():
    read = lambda x: C.read_expression(x.encode())
    assert read("mit or gpl-3.0-only")[0] == 1.0
    assert read("mit and gpl-3.0-only")[0] == 0.3
    assert read("mit or gpl-3.0-only and agpl-3.0")[0] == 1.0         # and binds tighter
    assert read("(mit or gpl-3.0-only) and agpl-3.0")[0] == 0.2
    assert read("gpl-2.0 with classpath-exception-2.0")[0] == pytest.approx(0.5)
    assert read("gpl-2.0 with classpath-exception-2.0")[1] == {"gpl-2.0"}
    for broken in ("mit or", "(mit", "mit)", "and mit", "mit mit", ""):
        assert read(broken)[2] is False
    assert C.to_postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]


@pytest.mark.parametrize("tail,labels,score", [
    ("this and that we say more", "", 0.0), ("this and that", "", 0.0), ("", "", 0.0),
    ("MIT", "mit", 1.0), ("MIT */", "mit", 1.0), ("Artistic-2.0 see the file", "artistic-2.0", 0.5),
    ("BSL-1.0 // boost", "bsl-1.0", 0.5), ("GPL-2.0 OR MIT in this repository", "gpl-2.0,mit", 0.5),
    ("MIT mitigate mitochondrial MPLS", "mit", 0.5), ("Apache License 2.0", "apache-2", 1.0),
    ("Apache License, Version 2.0", "apache-2", 1.0), ("GPL v2 or MIT License", "gpl-2,mit", 1.0),
    ("LicenseRef-Own AND (MIT OR ISC", "licenseref-own", 0.5), ("MIT with nothing", "mit", 0.5),
    ("GPL-2.0 WITH Linux-syscall-note", "gpl-2.0", 1.0), ("(((MIT)))", "mit", 1.0)])
def test_expression_after_tag(tail, labels, score):
    r = C.scan(f"x\n// SPDX-License-Identifier: {tail}\nmpl and gpl".encode())
    assert (r["labels"], r["score"]) == (labels, score)


def test_tags_of_one_line_take_linear_time():
    """Each tag is read to the next one; words in between without the tag's marks are no tag."""
    r = C.scan(b"spdx license identifier isc. " + b"SPDX-License-Identifier: MIT " * 3 + b"SPDX-License-Identifier:gpl-2.0")
    assert r["labels"] == "gpl-2.0,mit"
    for unit in (b"SPDX-License-Identifier: MIT ", b"SPDX-License-Identifier: (", b"SPDX-License-Identifier:mit"):
        start = time.perf_counter()
        C.scan(unit * 4_000)
        assert time.perf_counter() - start < 0.5
    many = b" or ".join(b"licenseref-%d" % i for i in range(20_000))
    start = time.perf_counter()
    assert C.scan(b"SPDX-License-Identifier: " + many)["labels"].count(",") == 19_999
    assert time.perf_counter() - start < 3


def test_license_in_a_very_long_text():
    text = "word " * 400_000 + "under the MIT license\nSPDX-License-Identifier: ISC OR MPL-2.0"
    r = C.scan(text.encode())
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licenses(text)
    assert r["labels"] == "isc,mit,mpl-2.0" and r["score"] == 1.0


def test_license_edges(spark, edge, empty):
    rows = C.license_scan(edge).collect()
    assert len(rows) == len(EDGE)
    r = next(r for r in rows if r.doc_id == 8)
    assert r.base_labels == "" and r.labels == "apache-2,bsd-3-clause,mit" and r.score == 1.0 and r.openness == 1.0
    assert C.license_scan(empty).count() == 0


def test_punctuation_after_an_identifier_is_not_in_its_label():
    found = C.scan(b"SPDX-License-Identifier: MIT, see the file\n# SPDX-License-Identifier: (MPL-2.0; or GPL-3.0)")
    assert found["labels"] == "gpl-3.0,mit,mpl-2.0"


@pytest.mark.parametrize("line,value,names", [
    ("Artistic-2.0 see the file", 0.8, "artistic-2.0"), ("BSL-1.0 // boost", 1.0, "bsl-1.0"),
    ("Ruby // of the gem", 0.9, "ruby"), ("MIT we mitigate what mitochondrial and MPLS do", 1.0, "mit"),
    ("GPL-2.0 OR MIT in this repository", 1.0, "gpl-2.0,mit"), ("MIT OR later at your option", 1.0, "mit"),
    ("(MIT OR GPL-2.0) AND AGPL-3.0 see (the file", 0.2, "agpl-3.0,gpl-2.0,mit"),
    ("GPL-2.0+ with the rest", 0.3, "gpl-2.0+"), ("see the MIT file", 1.0, "mit"), ("see the file", None, "")])
def test_expression_before_prose(line, value, names):
    found = C.scan(f"SPDX-License-Identifier: {line}".encode())
    assert (found["openness"], found["labels"]) == (value, names)


JUDGED = "lang string, source string, " + ", ".join(f"{c} bigint" for c in Q.COUNTS)


def test_groups_of_any_size_are_judged_alike(spark):
    """Sources of another form than their language: no size switches the verdict."""
    from pyspark.sql import functions as F
    prose = [("en", f"s{i % 3}", 100 + i % 40, 500 + 7 * (i % 40), i % 3, 0, 0, 4, 9) for i in range(3000)]
    kept = {}
    for n in (150, 199, 200, 250):
        code = [("en", "code", 100, 520, 45 + i % 11, 0, 0, 4, 9) for i in range(n)]
        rows = spark.createDataFrame(prose + code, JUDGED)
        judged = Q.verdict(rows, Q.thresholds(rows))
        got = {r.source: r["kept"] / r.n for r in judged.groupBy("source").agg(
            F.sum(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
        kept[n] = got.pop("code")
        assert set(got.values()) == {1.0}
    assert set(kept.values()) == {1.0}
    one = spark.createDataFrame(prose + [("en", "new", 100, 520, 90, 0, 0, 4, 9)], JUDGED)
    assert [r.kept for r in Q.verdict(one, Q.thresholds(one)).where("source = 'new'").collect()] == [False]


@pytest.mark.parametrize("share", [0.1, 0.34, 0.45])
def test_a_polluted_hot_source_keeps_its_fences(spark, share):
    """Junk in a third or more of a hot source's documents does not move the fences: it goes, the rest stays."""
    from pyspark.sql import functions as F
    n = 4000
    bad = int(n * share)
    prose = [("en", "small", 100 + i % 40, 500 + 7 * (i % 40), i % 3, 0, 0, 4, 9) for i in range(300)]
    clean = [("en", "hot", 100 + i % 40, 500 + 7 * (i % 40), i % 3, 0, 0, 4, 9) for i in range(n - bad)]
    junk = {"symbols": (100, 520, 120, 0, 0, 4, 9), "lines": (100, 520, 1, 8, 0, 4, 9), "letters": (100, 120, 1, 0, 0, 4, 9),
            "upper": (100, 520, 1, 0, 0, 500, 9), "long words": (100, 3000, 1, 0, 0, 4, 9)}
    for name, counts in junk.items():
        rows = spark.createDataFrame(prose + clean + [("en", "hot", *counts)] * bad, JUDGED)
        judged = Q.verdict(rows, Q.thresholds(rows)).withColumn("junk", F.array(*Q.COUNTS) == F.array(*[F.lit(c).cast("bigint") for c in counts]))
        got = {r.junk: (r.n, r["kept"]) for r in judged.groupBy("junk").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
        assert got == {True: (bad, 0), False: (n - bad + 300, n - bad + 300)}, name


def test_repeated_lines_are_judged(spark):
    """A text goes by its share of repeated lines alone, where no window of words repeats."""
    line = lambda i, j: " ".join(f"word{i:03d}x{j}x{k}" for k in range(6))
    rows = [(i, "\n".join(line(i, j) for j in range(6)), "en", "a") for i in range(300)]
    rows.append((900, "\n".join(f"{line(900, j)}\nmenu" for j in range(10)), "en", "a"))
    rows.append((901, "\n".join([f"{line(901, 0)} {line(901, 1)}", "menu", "menu"]), "en", "a"))     # one of three stays
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert (got[900].n_lines, got[900].n_dup_lines, got[900].n_repeat_words) == (20, 9, 0)
    assert [i for i, r in got.items() if not r.kept and i < 900] == []
    assert not got[900].base_failed and not got[900].kept and (got[901].n_dup_lines, got[901].kept) == (1, True)

"""The operators against brute force, exact round trips, and held-out accuracy; with nulls, empty texts, repeated rows,
empty tables, and columns whose names clash."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import common, graph, ngramjoin, packing, queries, tokenfile, toxicity, urlfilter
from tests.llm.tables import WORD, frame, words

DATA = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, short, empty, null and long texts, and ids that are null or repeated."""
    base = [words(i, 60 + i) for i in range(12)]
    passage = words(99, 35, 1000)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20 + i, base[1]) for i in range(5)]
    rows += [(30 + i, base[2].replace("w7", f"x{i}", 1)) for i in range(5)]
    rows += [(40 + i, f"{words(200 + i, 9)}\t{passage}\n{words(300 + i, 15)}") for i in range(5)]
    rows += [(50, None), (51, ""), (52, " \n"), (53, "one"), (54, "one two"), (55, "One  Two"), (56, words(5, 4000)), (57, words(6, 30) + " " + words(6, 30))]
    rows += [(None, base[3]), (None, "null id"), (60, "same row"), (60, "same row"), (61, base[4]), (61, base[5]), (62, "é ß 漢字 \U0001f600 x" * 9)]
    random.Random(1).shuffle(rows)
    return rows


def grams(text, size):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(sets, percent):
    up = list(range(len(sets)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    return [top(i) for i in range(len(sets))]


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_ngram_join(spark, corpus, size, percent, monkeypatch):
    if size == 1:  # frequent n-grams and several blocks are met in small tables too
        monkeypatch.setattr(ngramjoin, "HOT", 3)
        monkeypatch.setattr(ngramjoin, "BLOCK", 4)
    sets = [grams(t, size) for _, t in corpus]
    roots = components(sets, percent)
    least = {}
    for (i, _), r in zip(corpus, roots, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = Counter((i, len(s), least.get(r)) for (i, _), s, r in zip(corpus, sets, roots, strict=True))
    assert Counter(map(tuple, ngramjoin.join_documents(frame(spark, corpus), size, percent).collect())) == want


def test_words_of_two_letters_in_a_certain_order(spark):
    """Polynomials modulo 2**64 take these for each other."""
    order = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    flipped = order.translate(str.maketrans("ab", "ba"))
    rows = [(i, f"{w[: 1 << k]} one two three four") for k in (4, 5, 9, 10, 12) for i, w in ((2 * k, order), (2 * k + 1, flipped))]
    got = {r["doc_id"]: r["component_id"] for r in ngramjoin.join_documents(frame(spark, rows), 4, 60).collect()}
    assert all(got[i] == i for i in got) and len(got) == 10


def test_word_hashes():
    """Of words of any length, wherever they lie: equal for equal words alone."""
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("ab") for _ in range(n)) for n in [*range(1, 90), *range(1, 90), 7, 8, 9, 63, 64, 65, 1000] for _ in range(2)).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]))
    hashes = common.word_hashes(data, starts, ends).tolist()
    own = [text[s:e] for s, e in zip(starts, ends, strict=True)]
    assert len(set(zip(own, hashes, strict=True))) == len(set(own)) == len(set(hashes))


def test_classes_of_equal_number_are_told_apart(spark):
    rows = [(1, 5, 7), (2, 5, 7), (3, 5, 8), (4, 6, 7), (5, None, None), (6, 5, 9), (7, 5, 8)]
    got = {r["doc_id"]: r["cls"] for r in ngramjoin.told_apart(spark.createDataFrame(rows, "doc_id long, cls long, check long")).collect()}
    assert got[1] == got[2] == 5 and got[4] == 6 and got[5] is None and got[3] == got[7] and len({got[1], got[3], got[4], got[6]}) == 4


@pytest.mark.parametrize(("pivots", "left"), [(1, 3), (8, 512)])
def test_ngram_join_of_long_chains(spark, monkeypatch, pivots, left):
    """Texts that are linked with their neighbours alone: blocks and pivots leave most of the family to the second step."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 8)
    monkeypatch.setattr(ngramjoin, "PIVOTS", pivots)
    monkeypatch.setattr(ngramjoin, "LEFT", left)
    chain = lambda at, n: [" ".join(f"w{at + i + j}" for j in range(10)) for i in range(n)]
    rows = [(i, t) for i, t in enumerate(chain(0, 50) + chain(55, 20) + chain(0, 3) + ["x y z"])]
    random.Random(2).shuffle(rows)
    sets = [grams(t, 1) for _, t in rows]
    roots = components(sets, 80)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    got = ngramjoin.join_documents(frame(spark, rows), 1, 80).collect()
    assert Counter(map(tuple, got)) == Counter((i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, roots, strict=True))


def test_many_copies_of_one_text(spark):
    """A third of all rows are one text, as many are null, under ids of their own."""
    rows = [(3 * i, words(1, 30)) for i in range(1500)] + [(3 * i + 1, None) for i in range(1500)] + [(3 * i + 2, words(10 + i, 30, 5000)) for i in range(1500)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngramjoin.join_documents(frame(spark, rows), 5, 80).collect()}
    assert len(got) == 4500 and all(got[i] == (0 if i % 3 == 1 else 26, i if i % 3 else 0) for i in got)
    assert ngramjoin.one_of_each(frame(spark, rows), 5, 80).count() == 3001


def test_one_of_each(spark, corpus):
    docs = frame(spark, corpus)
    got = ngramjoin.one_of_each(docs)
    assert got.columns == docs.columns
    sets = [grams(t, 5) for _, t in corpus]
    groups = defaultdict(list)
    for (i, t), s, r in zip(corpus, sets, components(sets, 80), strict=True):
        groups[r if s else f"empty {i}"].append((i is not None, i, t))
    kept = got.collect()
    assert len(kept) == len(groups)
    assert Counter(r["doc_id"] for r in kept) == Counter(min(g, key=lambda x: (x[0], x[1] or 0))[1] for g in groups.values())
    assert ngramjoin.one_of_each(docs.limit(0)).isEmpty() and ngramjoin.join_documents(docs.limit(0)).isEmpty()


@pytest.mark.parametrize("few", [0, graph.FEW])
def test_components_of_chains_and_stars(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    rng = random.Random(4)
    name = [rng.getrandbits(62) for _ in range(400)]
    edges = [(name[i], name[i + 1]) for i in range(199)] + [(name[300], name[i]) for i in range(250, 400)]
    got = {r["vertex"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert len(got) == 350 and len({got[x] for x in name[:200]}) == len({got[x] for x in name[250:]}) == 1 and got[name[0]] != got[name[300]]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (11, 10), (5, 5)], "a long, b long")
    got = {r["vertex"]: r["root"] for r in graph.components(edges).collect()}
    assert len({got[i] for i in (1, 2, 3, 4)}) == 1 and got[10] == got[11] != got[1]


def test_toxicity_on_held_out_rows(spark):
    """By language: the classifier must know what it has not seen, not remember what it has."""
    table = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{table}/labels.parquet").join(spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = queries.op3_toxicity(spark, table).join(marks, "doc_id").filter("held_out and toxic is not null").collect()
    toxic = {lang: [r["predicted"] for r in rows if r["toxic"] == 1 and r["lang"] == lang] for lang in ("en", "de", "fr", "es")}
    assert all(np.mean(x) >= 0.7 for x in toxic.values()) and np.mean(sum(toxic.values(), [])) > 0.88  # recall
    assert np.mean([r["toxic"] for r in rows if r["predicted"]]) > 0.95  # precision
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97


def test_toxicity_scores_are_sums_of_features():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(("ab", "abc", "X", "öd", "ab\u0301")) for _ in range(rng.randrange(40))) for _ in range(40)]
    labels = np.array([i % 2 for i in range(40)])
    model = toxicity.fit([toxicity.features(t) for t in texts], labels, 1e-2)
    for t in [*texts, None, "", " \n ", "a"]:
        plain = f" {' '.join((t or '').lower().split())} " if (t or "").split() else ""
        counts = Counter()
        for n in toxicity.GRAMS:
            for i in range(len(plain) - n + 1):
                h = sum((ord(c) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k, c in enumerate(plain[i : i + n])) + n & (1 << 64) - 1
                counts[((h ^ h >> 29) * pow(0x9E3779B97F4A7C15, 2, 1 << 64) & (1 << 64) - 1) >> 64 - toxicity.BITS] += 1
        x = model.bias + sum(float(model.weights[g]) * float(np.log1p(c)) for g, c in counts.items())
        assert model.score(t) == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-6)


def test_toxicity_sample_is_bounded(spark):
    rows = [(i, f"{words(i, 20)} {'bad' if i % 2 else 'good'}") for i in range(60)] + [(100, "long " * 9000 + "bad"), (100, "another text of the same id")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100, 1)], "doc_id long, toxic int")
    seen = []
    toxicity.train(frame(spark, rows), labels, most_chars=500)
    original = toxicity.fit
    try:
        toxicity.fit = lambda examples, marks, *a, **k: (seen.append((len(examples), int(marks.sum()))), original(examples, marks, 1e-2))[1]
        toxicity.train(frame(spark, rows), labels, most_chars=500)
        toxicity.train(frame(spark, rows), labels)
    finally:
        toxicity.fit = original
    assert 2 <= seen[0][0] < 20 and seen[1] == (62, 32)


def test_toxicity_cases(spark, corpus):
    docs = frame(spark, corpus)
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score(docs, none).collect()
    assert len(got) == len(corpus) and all(0 <= r["score"] < 0.5 for r in got)
    assert toxicity.reject(docs, none).count() == len(corpus)
    bad = [(100 + i, f"vile {words(i, 5)} slur") for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in corpus if i is not None] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, corpus + bad), labels)
    kept = toxicity.reject(frame(spark, [*corpus, (999, "vile w3 slur")]), model)
    assert 999 not in [r["doc_id"] for r in kept.collect()] and kept.columns == docs.columns
    assert toxicity.score(docs.limit(0), model).isEmpty()


def test_toxicity_of_a_very_long_text(spark):
    """Two megabytes, scored whole: what stands at its end counts."""
    long = words(1, 300_000, 5000)
    bad = [(i, f"{words(i, 6)} vile slur {words(i + 50, 6)}") for i in range(30)]
    good = [(100 + i, words(i + 500, 14)) for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i, _ in bad] + [(i, 0) for i, _ in good], "doc_id long, toxic int")
    model = toxicity.train(frame(spark, bad + good), labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, [(1, long), (2, long + " vile slur" * 50_000), (3, "vile slur")]), model).collect()}
    assert got[1] < got[2] and got[3] > 0.5 and all(0 <= x <= 1 for x in got.values())


def test_rules_of_equal_length(spark):
    """Of two rules of one length that fit, the first by verdict and then by host counts, wherever they stand in the list."""
    pages = spark.createDataFrame([(1, "http://a.b/cd")], "page_id long, url string")
    rules = [("block", "a.b", "/c"), ("allow", "a.b", "/c")]
    seen = {tuple(urlfilter.filter_urls(pages, r).select("rule", "verdict").first()) for r in (rules, rules[::-1])}
    assert len(seen) == 1


def all_ids(rows):
    t = Tokenizer.from_file(WORDS)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for _, x in rows]


def test_token_file(spark, corpus, tmp_path):
    docs = frame(spark, corpus)
    path = tokenfile.write_token_ids(docs, f"file://{tmp_path}/ids", WORDS)
    rows = tokenfile.read_token_ids(spark, path)
    got = tokenfile.token_summary(rows).collect()
    want = Counter((i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(corpus, all_ids(corpus), strict=True))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert rows.filter("doc_id = 56").select("ids").first()[0] == all_ids([(0, dict(corpus)[56])])[0].tolist()
    empty = tokenfile.write_token_ids(docs.limit(0), f"file://{tmp_path}/none", WORDS)
    assert tokenfile.token_summary(tokenfile.read_token_ids(spark, empty)).isEmpty()


def test_ids_of_letters_before_marks():
    """Every letter before every mark that may end a word; some come apart into a letter and a mark, which goes with what follows."""
    from shelfmark.llm.tokens import encoder

    encode, library = encoder(WORDS), Tokenizer.from_file(WORDS)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    odd = [c for c in letters if len(encode.normalise(c)) != 1 or not encode.normalise(c).isalpha()]
    assert 50 < len(odd) < 5000 and "\u0958" in odd
    marks = random.Random(2)
    texts = [f"a{c}{m} {c}{m}" for c in odd for m in ".,;:!?"] + [f"a{c}{marks.choice('.,;:!?')}" for c in letters if not "\u4e00" <= c <= "\ud7a3" and c < "\U00010000"] + [f"{c}." for c in letters[::23]]
    for t in texts:
        assert encode.encode(t) == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), ascii(t)


@pytest.mark.parametrize("parts", [1, 16, 211])
def test_packing_has_little_padding(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs.repartition(parts), WORDS).groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert sum(r[1] for r in got) / (2048 * len(got)) > 0.97


def test_packing(spark, corpus):
    got = packing.pack(frame(spark, corpus).repartition(2), WORDS, capacity=64, block=16).collect()
    pieces_of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert 1 <= r["length"] <= 64 and r["length"] * 4 == len(r["ids"])
        pieces_of[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert Counter(np.frombuffer(b"".join(r["ids"] for r in got), "<u4").tolist()) == Counter(np.concatenate(all_ids(corpus)).tolist())
    for (i, _), ids in zip(corpus, all_ids(corpus), strict=True):
        if i not in (None, 60, 61):
            assert b"".join(r["ids"] for r in sorted(pieces_of[i], key=lambda r: r["start"])) == ids.tobytes()
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert total / (64 * len(sequences)) > 0.9
    assert packing.pack(frame(spark, []), WORDS).isEmpty()


def test_token_file_prunes(spark, tmp_path):
    """Footers, row groups and Bloom filters each save reading."""
    rows = [(2 * i, f"a{i}") for i in range(14_000)]
    path = tokenfile.write_token_ids(frame(spark, rows), f"file://{tmp_path}/ids", WORDS)
    some = next(iter(sorted(tmp_path.glob("ids/part-*.orc"))))
    jvm = spark._jvm
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f"file://{some}"), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    found = reader.rows()
    footer = found.readStripeFooter(reader.getStripes().get(0))
    kinds = {footer.getStreams(i).getKind().toString() for i in range(footer.getStreamsCount())}
    encodings = {footer.getColumns(i).getKind().toString() for i in range(footer.getColumnsCount())}
    found.close()
    assert {"ROW_INDEX", "BLOOM_FILTER_UTF8"} <= kinds and "DIRECT_V2" in encodings and reader.getRowIndexStride() == 2000

    def scanned(condition):
        df = spark.read.schema(tokenfile.SCHEMA).orc(path).filter(condition)
        got = len(df.collect())
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return got, leaf.metrics().apply("numOutputRows").value()

    assert scanned("doc_id >= 0") == (14_000, 14_000)
    got, read = scanned("doc_id = 10000")
    assert got == 1 and read <= 2000  # one row group of one file
    got, read = scanned("doc_id = 10001")  # between the least and the largest id of a row group, but not there
    assert got == 0 and read == 0


def test_token_file_of_an_id_with_many_rows(spark, tmp_path):
    """Its rows lie in several files; those of other ids keep their order."""
    rows = [(None, f"a{i}") for i in range(5000)] + [(7, f"b{i}") for i in range(2000)] + [(i, f"c {i}") for i in range(20)]
    path = tokenfile.write_token_ids(frame(spark, rows), f"file://{tmp_path}/ids", WORDS)
    read = tokenfile.read_token_ids(spark, path)
    got = sorted(tokenfile.token_summary(read).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((i, zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, all_ids(rows), strict=True))
    assert read.filter("doc_id is null").select("file").distinct().count() > 1


def test_token_files_in_order_of_their_numbers(spark):
    """Names are not padded to more than five digits."""
    rows = [(i, 0, 1, [i], f"part-{n}-x.c000.orc") for i, n in enumerate(("00000", "00002", "99999", "100000"))]
    table = spark.createDataFrame(rows, "doc_id long, position long, n_tokens long, ids array<int>, file string")
    assert sorted((r["doc_id"], r["start"]) for r in tokenfile.token_summary(table).collect()) == [(i, i) for i in range(4)]


def test_differencing():
    rng = random.Random(3)
    for count in (1, 2, 7):
        sizes = [rng.randint(1, 100) for _ in range(60)]
        sets = packing.difference(sizes, count)
        assert sorted(i for s in sets for i in s) == list(range(60)) and len(sets) == count
        sums = [sum(sizes[i] for i in s) for s in sets]
        assert max(sums) - min(sums) <= 20
    assert packing.difference([], 2) == [[], []]
    assert len(packing.windows([6, 6, 6], 10)) == 3  # more windows than the sum needs


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_url_filter_cases(spark):
    rows = [(1, "https://a.example.com/en/75?x", "h"), (2, "http://EXAMPLE.com/en/8", "h"), (3, None, "h"), (4, "no scheme", "h"), (5, "x://notcom/en/", "h"), (5, "x://notcom/en/", "h"), (6, "x://b.net/de/8#f", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in urlfilter.filter_urls(pages, queries.URL_RULES).collect() if r["page_id"] != 3)
    assert got == [(1, "a.example.com", "example.com/en/7", "allow"), (2, "example.com", "com/en/", "block"), (4, "", None, "allow"), (5, "notcom", None, "allow"), (5, "notcom", None, "allow"), (6, "b.net", "net/de/", "allow")]
    assert urlfilter.filter_urls(pages.limit(0), queries.URL_RULES).isEmpty()
    assert {r["verdict"] for r in urlfilter.filter_urls(pages, []).collect()} == {"allow"}

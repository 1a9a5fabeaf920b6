"""The operators against brute force, on small tables with nulls, repeats, ties, long texts and odd names."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from saldo.llm import ann, decontamination, language_id, line_dedup, piece_scan, pii, quality, simhash, suffix_dedup, url_filter
from saldo.llm.common import table
from saldo.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, host string, row long, fp string"


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 1, "h", 7, "x") for i, t in zip(ids, texts, strict=True)], DOCS)


@pytest.fixture(scope="module")
def given(spark):
    return table(spark, SMALL, "documents")


def test_every_query_survives_empty_tables_and_nulls(spark, tmp_path):
    """Empty tables give empty results; a row of nulls gives one row (none in searches) and no error."""
    names = ("documents", "pages", "embeddings", "benchmark", "labels")
    for kind in ("empty", "nulls"):
        for name in names:
            schema = table(spark, SMALL, name).schema
            rows = [] if kind == "empty" else [tuple(None for _ in schema)]
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{kind}/{name}.parquet")
        for name, query in QUERIES.items():
            rows = 1 if kind == "nulls" and not name.startswith(("op9", "op10", "op11", "op13")) else 0
            assert query(spark, f"{tmp_path}/{kind}").count() == rows, (kind, name)


def test_op1_url_filter(spark):
    day = lambda n: f"2024-01-{n:02d}"
    entries = spark.createDataFrame([
        ("a.com", day(5), "block"), ("a.com", day(20), "lift"), ("x.a.com", day(8), "allow"),
        ("x.a.com/p", day(10), "block"), ("b.com", day(3), "allow"), ("b.com", day(3), "block"),
        (None, day(1), "block"), ("c.com", None, "block"), ("c.com", day(1), "odd"),
    ], "key string, day string, verdict string").withColumn("day", F.col("day").cast("date"))
    rows = [
        ("http://a.com/", day(4), "none", None), ("http://a.com/", day(5), "block", "a.com"),
        ("https://y.A.com:80/q", day(19), "block", "a.com"), ("http://a.com", day(20), "none", None),
        ("http://x.a.com/z", day(9), "allow", "x.a.com"), ("http://u@x.a.com/p/q", day(9), "allow", "x.a.com"),
        ("http://x.a.com/p?k", day(31), "block", "x.a.com/p"), ("http://b.com", day(3), "block", "b.com"),
        ("ftp://a.com", day(6), "unparsed", None), (None, day(6), "unparsed", None), ("http://a.com", None, "none", None),
        ("http://" + "a." * 200 + "com", day(9), "unparsed", None), ("http://c.com", day(9), "none", None),
    ]
    captures = spark.createDataFrame([(u, d, "k", 3) for u, d, _, _ in rows] * 2, "url string, day string, key string, rank int")
    captures = captures.withColumns({"day": F.col("day").cast("date"), "verdict": F.lit("old")})
    got = url_filter.judge(captures, entries).select("url", F.col("day").cast("string"), "verdict", "rule").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows * 2))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return {
        "email": True, "ip": kind == "ip" and all(int(x) < 256 for x in match.split(".")),
        "card": 13 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0, "phone": 9 <= len(digits) <= 15,
    }[kind]


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_op2_base_spans(spark):
    rnd = random.Random(2)
    bits = ["a@b.c", "x.y%z@d-e.f.g", "@", ".", " ", "-", "1", "255.1.1.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "5500005555555559", " +1 (222) 333-4444", "+", "(222) 333-4444", "é", "😀", "joe(at)ex.com", "_",
            "\n", "00000000", "..", "+49 30 123456 78", "a@b.c_d@e.f", "9" * 25]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "1 " * 20000, "a." * 9000 + "@" + "b." * 9000 + "c", "+1" + " " * 30000 + "2"]
    ids = [*range(len(texts) - 1), 0]
    got = pii.op2_personal_data(documents(spark, texts, ids)).collect()
    want = sorted((hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest(), i) for i, t in zip(ids, texts, strict=True))
    assert sorted((r["base_sha256"], r["doc_id"]) for r in got) == want
    for r in got:
        if r["doc_id"]:
            base = base_spans(texts[r["doc_id"]])
            assert set(base) <= set(r["spans"].split(",")) | {""}
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]


def test_op2_model_adds_likely_spans_and_spares_others(spark):
    rnd, texts = random.Random(3), []
    for i in range(600):
        number = f"+1 ({rnd.randint(200, 999)}) {rnd.randint(200, 999)}-{rnd.randint(1000, 9999)}"
        texts.append(f"call {number} now" if i % 2 else f"call {number[3:]} now" if i % 4 else f"build 1.2.{i} of part {i}00{i}")
    got = {r["doc_id"]: r["spans"] for r in pii.op2_personal_data(documents(spark, texts)).collect()}
    assert all(got[i] for i in range(600) if i % 2)
    assert not any(got[i] for i in range(0, 600, 4))
    out = pii.redact(documents(spark, texts[:2])).collect()
    assert {r["doc_id"]: r["text"] for r in out}[1] == "call [phone] now"


def test_op2_spelled_out_addresses_need_attested_domains(spark):
    """Spelled-out addresses are found in contexts in which the corpus attests most of them, and ordinary words are not."""
    rnd, texts = random.Random(4), []
    odd = ["We meet (at) noon. then go home", "Look [at] this. And that"]
    for i in range(1200):
        domain = f"site{rnd.randint(1, 9)}.org"
        texts.append((f"write u{i}@{domain} now", f"mail to u{i} (at) {domain} now", f"They met (at) noon{i}. then left")[i % 3])
    texts += [*odd, "mail to u77 (at) else7.org now"]
    got = {r["doc_id"]: r["spans"] for r in pii.op2_personal_data(documents(spark, texts)).collect()}
    assert all(got[i].startswith("email:") for i in range(1200) if i % 3 < 2)
    assert not any(got[i] for i in range(1200) if i % 3 == 2)
    # a domain that nothing attests is found where format and context are those of attested ones
    assert (got[1200], got[1201]) == ("", "") and got[1202] == "email:8:26"


def test_op2_adds_nothing_without_both_outcomes(spark):
    """Many ordinary addresses are no evidence about spelled-out ones."""
    texts = [f"write u{i}@site.org now" for i in range(400)] + ["We meet (at) noon. then go home", "Look [at] this. And that"]
    got = {r["doc_id"]: r["spans"] for r in pii.op2_personal_data(documents(spark, texts)).collect()}
    assert (got[400], got[401]) == ("", "") and all(got[i] for i in range(400))


def test_op2_redact_cuts_each_text_by_its_own_spans(spark):
    texts = [f"{'x' * (i % 7)} u{i}@site.org and {i}" if i % 2 else f"{i} none" for i in range(200)]
    docs = documents(spark, texts).repartition(7, F.rand())
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {i: f"{'x' * (i % 7)} [email] and {i}" if i % 2 else f"{i} none" for i in range(200)}


def test_op3_keeps_clean_text(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    both = quality.op3_quality(docs).join(labels, "doc_id").collect()
    assert len(both) == labels.count()
    assert sum(r["keep"] == (r["quality"] == 1) for r in both) > 0.95 * len(both)
    assert sum(not r["keep"] for r in both if r["quality"] == 1) <= 0.01 * len(both)
    odd = quality.op3_quality(documents(spark, [None, "", "One plain sentence stands here."])).orderBy("doc_id").collect()
    assert [r["score"] for r in odd[:2]] == [0.0, 0.0]


@pytest.mark.parametrize("text", ["我们在公园里散步，天气很好。孩子们在湖边玩。\n", "今日は天気がいいので、公園を歩きました。子供も来ました。\n", "What a fine day it is for all of us!\n"])
def test_op3_keeps_clean_text_of_other_scripts(spark, text):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**7 + i, "".join(f"{i + j} {text}" for j in range(9))) for i in range(40)], "doc_id long, text string")
    )
    got = quality.op3_quality(docs).where("doc_id >= 10000000").collect()
    assert len(got) == 40 and all(r["keep"] for r in got)


def test_op4_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language_id.op4_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.98 * len(rows)
    model = language_id.learn_outside(docs)
    long = "the of and to in is that for was with " * 3000
    got = language_id.infer([None, "", "123 !?", long, "den der die und les des une pour"], model)
    assert [x[0] for x in got[:4]] == ["und", "und", "und", "en"] and got[0][1] == 0.0
    mixed = docs.where("lang = 'de'").first()["text"] + " " + docs.where("lang = 'fr'").first()["text"]
    assert set(language_id.infer([mixed], model)[0][2].split(",")) >= {"de", "fr"}


def brute_repeats(rows):
    least = {}
    known = [(suffix_dedup.UNKNOWN if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in known:
        for i in range(len(b) - 49):
            least[b[i : i + 50]] = min(least.get(b[i : i + 50], d), d)
    out = []
    for d, b in known:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if least[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        row = suffix_dedup.kept_of(d, np.frombuffer(b, np.uint8), gone, False)
        out.append((row[0], row[1], row[2], row[3], row[5]))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard, often", [(4 << 20, (32, 4)), (3000, (1, 1)), (20000, (2, 1))])
def test_op5_suffix_dedup(spark, shard, often):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcdefgh  é") for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(120):
        text = ""
        for _ in range(rnd.randint(0, 4)):
            a = rnd.randint(0, 300)
            text += rnd.choice(base)[a : a + rnd.randint(20, 200)] + "xyz"[: rnd.randint(0, 3)] * rnd.randint(0, 20)
        rows.append((rnd.choice([i, i, i - 1]) if i % 37 else None, text if i % 29 else None))
    rows += [(500, "a" * 30000), (501, "b" + "a" * 9000 + base[0] * 3), (9, "a" * 60), (9, "a" * 60)]
    docs = documents(spark, [t for _, t in rows], [d for d, _ in rows])
    got = suffix_dedup.drop_repeats(docs, shard, False, often).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(rows)


def test_op5_parts_match_brute_force():
    rnd = random.Random(5)
    for turn in range(60):
        pool = bytes(rnd.choice(b"ab" if turn % 2 else b"abcdefgh") for _ in range(300))
        some = {pool[a : a + rnd.randint(50, 100)] for a in (rnd.randint(0, 200) for _ in range(rnd.randint(1, 12)))}
        segments = sorted(some | ({b"a" * 120} if turn % 3 else set()))
        least = np.array([rnd.randint(0, 9) for _ in segments])
        known = {}
        for s, d in zip(segments, least.tolist(), strict=True):
            for i in range(len(s) - 49):
                known[s[i : i + 50]] = min(known.get(s[i : i + 50], 99), d)
        want = [known[s[i : i + 50]] for s in segments for i in range(len(s) - 49)]
        for size in (10**6, 150):  # one suffix array, or several that are merged
            assert suffix_dedup.least_documents(segments, least, size).tolist() == want


def test_op6_site_lines(spark):
    rows = []
    for i in range(60):
        rows.append(("Big.org", f"menu \nown line {i}\nrare {i % 12}\n\n  menu"))
    rows += [("small.org", "menu\nx")] * 9 + [(None, "menu\nx")] * 20 + [("big.org", None)]
    pages = spark.createDataFrame([(i, s, t, 1, "q") for i, (s, t) in enumerate(rows)], "page_id long, site string, text string, n int, line string")
    got = line_dedup.drop_site_lines(pages, F.lower("site"), dropped="went").orderBy("page_id").collect()
    assert got[0]["text"] == "own line 0\nrare 0\n" and got[0]["went"] == 2 and len(got) == len(rows)
    assert all((r["text"], r["went"]) == ("", 2) for r in got[60:69])  # a small site obeys the ratio, too
    assert all(tuple(r)[:5] == tuple(p) for r, p in zip(got[69:], pages.orderBy("page_id").collect()[69:], strict=True))
    spared = line_dedup.drop_site_lines(pages, F.lower("site"), min_pages=10, dropped="went")
    assert spared.where("site = 'small.org' and went = 0").count() == 9


def test_hosts_in_brackets_and_with_closing_dots(spark):
    urls = {
        "http://[2001:DB8::1]/x": "[2001:db8::1]", "https://u@[::1]:80": "[::1]", "http://a.com./x": "a.com", "http://A.com..:8/": "a.com",
        "http://./": None, "http://[::1/x": None, "http://a.com": "a.com", "ftp://a.com": None, None: None, "": None,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("host", line_dedup.host_of(F.col("url"))).collect()
    assert {r["url"]: r["host"] for r in rows} == urls
    entries = spark.createDataFrame([("a.com", "2024-01-01", "block"), ("[2001:db8::1]", "2024-01-01", "block")], "key string, day string, verdict string")
    captures = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("day", F.lit("2024-02-01").cast("date"))
    got = url_filter.judge(captures, entries.withColumn("day", F.col("day").cast("date"))).where("verdict = 'block'").collect()
    assert {r["url"] for r in got} == {u for u, h in urls.items() if h in ("a.com", "[2001:db8::1]")}


def test_op7_simhash(spark, given):
    texts = [r["text"] for r in given.orderBy("doc_id").collect()][:150]
    rnd = random.Random(1)
    for t in texts[:40]:
        words = t.split()
        words[rnd.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    texts += [None, "", " \n", texts[0], "one", "ONE"]
    ids = [*range(len(texts) - 1), None]
    fps = [simhash.fingerprint(t) for t in texts]
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    want = sorted((str(ids[i]), f"{fps[i] & (2**64 - 1):016x}", ids[root(i)]) for i in range(len(fps)))
    got = simhash.op7_simhash(documents(spark, texts, ids)).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == want
    rows = spark.createDataFrame([(i, f) for i, f in zip(ids, fps, strict=True)], "doc_id long, fp long")
    crowded = simhash.group_documents(rows, crowd=1).collect()  # every key counts as crowded
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in crowded) == [(a, c) for a, _, c in want]
    kept = simhash.keep_one_of_each(documents(spark, texts, ids))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in want}) and kept.columns[-1] == "fp"


def scanned(pieces, text, size):
    chunks = [piece_scan.Chunk(pieces, b, lo, hi, i == 0, i == n - 1) for i, n, b, lo, hi in piece_scan.cut(pieces.escaped(text), size, pieces.longest)]
    states = piece_scan.cut_states([c.matrix() for c in chunks])
    return [x for c, a, b in zip(chunks, states[:-1], states[1:], strict=True) for x in c.ids(a, b)]


def test_op8_scan_equals_the_library():
    model = piece_scan.read_model()
    pieces, library = piece_scan.Pieces(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    rnd = random.Random(1)
    words = ["hello", "the", "ation", "Zürich", "日本", "x" * 40, "😀", "\n", "ing", "123456", "== ", "   ", "▁", "internationalization"]
    for turn in range(160):
        text = (
            "".join(rnd.choice(words) + rnd.choice(["", " "]) for _ in range(rnd.randint(1, 60))) if turn % 3 == 0
            else "".join(rnd.choice("abcdetion ") for _ in range(rnd.randint(1, 300))) if turn % 3 == 1
            else rnd.choice(["a", "the", "aaab", "=", "  ", "ing"]) * rnd.randint(1, 120)
        )
        ids = library.encode(text)
        assert scanned(pieces, text, rnd.choice([32, 40, 64])) == ids
        assert pieces.decode(ids) == library.decode(ids)


def test_op8_scan_finds_the_best_unigram_path():
    spec = piece_scan.sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(piece_scan.read_model())
    spec.trainer_spec.model_type = 1
    pieces, rnd = piece_scan.Pieces(spec.SerializeToString()), random.Random(4)
    for _ in range(40):
        text = "".join(rnd.choice("theinar ") for _ in range(rnd.randint(33, 150)))
        whole, best = pieces.escaped(text), [0.0]
        for end in range(1, len(whole) + 1):
            starts = range(max(0, end - pieces.longest), end)
            best.append(max(best[a] + pieces.weight(whole[a:end]) for a in starts if pieces.valid(whole[a:end])))
        found = sum(pieces.scores[pieces.bare.id_to_piece(i)] for i in scanned(pieces, text, 32))
        assert found == pytest.approx(best[-1])


def test_op8_round_trip(spark, given):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_scan.MODEL)
    texts = [r["text"] for r in given.collect()][:60] + [None, "", "x" * 5000, "tab\t\x00 end "]
    got = piece_scan.encode_texts(documents(spark, texts), chunk=500).collect()  # most texts are giant
    assert len(got) == len(texts)
    kept = piece_scan.encode_texts(documents(spark, texts), chunk=500, keep=("doc_id", "row", "host"))
    assert kept.columns == ["doc_id", "row", "host", "text", "token_ids"] and kept.where("row = 7").count() == len(texts)
    for r in got:
        assert r["token_ids"] == (None if r["text"] is None else library.encode(r["text"]))
    assert all(r["round_trip"] for r in piece_scan.op8_pieces(documents(spark, texts)).collect())


def test_op9_recall_and_order(spark):
    rnd = np.random.default_rng(5)
    vectors = rnd.standard_normal((900, 32)) * rnd.uniform(0.1, 4.0, 900)[:, None]
    vectors[100:140] = vectors[100]  # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    rows += [(2000, None, 0), (2020, [0.0] * 32, 0), (2040, [float("nan")] * 32, 0), (2060, [None] * 32, 0), (2080, [1.0] * 5, 0), rows[0], (None, rows[1][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label int")
    got = defaultdict(list)
    found = ann.search(df, F.col("vec_id") % 20 == 0, 10, block=256, sample=400)
    for r in found.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for q, near in got.items():
        score = np.multiply(vectors, vectors[q]).sum(axis=1)
        order = [int(i) for i in np.lexsort((np.arange(900), -score)) if i != q][:10]
        assert len(near) == 10 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(score[i]) for i, s in near)
        hits += len({i for i, _ in near} & set(order))
    assert hits >= 0.9 * 10 * len(got)
    few = ann.search(df.where("vec_id < 5"), F.lit(True), 20)
    assert few.count() == 5 * 4


def test_op9_one_long_vector_outside_the_sample(spark):
    rnd = np.random.default_rng(6)
    vectors = rnd.standard_normal((3000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = spark.range(3000).orderBy(F.xxhash64("id"), "id").collect()
    for norm in (1.2, 3.0, 10.0):  # the first stays in the block of the others
        longer = vectors.copy()
        longer[ids[-1]["id"]] *= norm
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(longer)], "vec_id long, v array<double>")
        got = defaultdict(set)
        for r in ann.search(df, F.col("vec_id") % 20 == 0, 20, sample=1000).collect():
            got[r["query_id"]].add(r["vec_id"])
        hits = 0
        for q, near in got.items():
            score = longer @ longer[q]
            score[q] = -np.inf
            hits += len(near & set(np.argsort(-score)[:20].tolist()))
        assert len(got) == 150 and hits >= 0.95 * 20 * 150, (norm, hits)


def test_op10_finds_copies_and_spares_others(spark, given):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [" ".join(word() for _ in range(40)) for _ in range(8)] + [None, "", "too short now"]
    edited = items[1].split()
    for at in range(3, 40, 6):
        edited[at] = "other"
    del edited[20]
    texts = [
        f"start {items[0].upper()}, end", "a b c " + " ".join(edited) + " x", " ".join(items[2].split()[:10]), None, "",
        "too short now", "word " * 20000 + items[3], "of the and " * 50,
    ]
    texts += [f"{word()} {items[4]} {word()}" for _ in range(30)]  # a passage that most documents hold
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*items, items[5]])], "item_id long, text string, gram int")
    want = {(0, 0), (1, 1), (5, 10), (6, 3)} | {(i, 4) for i in range(8, 38)}
    got = decontamination.contaminated(documents(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    clean = decontamination.keep_clean(documents(spark, texts), bench)
    assert {r["doc_id"] for r in clean.collect()} == {2, 3, 4, 7}
    spot = next(r for r in got if r["doc_id"] == 6)
    assert (spot["first_word"], spot["end_word"], spot["score"]) == (20000, 20040, 1.0)


@pytest.mark.parametrize("step", [4, 5])
def test_op10_edited_copies_are_found_beside_verbatim_ones(spark, step):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (20, 40, 59)]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    edited = [" ".join("other" if at % step == step - 1 else w for at, w in enumerate(t)) for t in items]
    for copies in (0, 1, 3):
        texts = edited + [" ".join(t) for t in items] * copies
        found = decontamination.contaminated(documents(spark, texts), bench).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i % 3) for i in range(len(texts))}
    assert decontamination.keep_clean(documents(spark, texts), bench).count() == 0


def plain_score(item, text):
    """Smith-Waterman cell by cell: match +2, other word -1, gap -1."""
    above, best = [0] * (len(text) + 1), 0
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (2 if word == other else -1), above[j + 1] - 1, row[j] - 1))
        above, best = row, max(best, *row)
    return best


def changed(words, step, kind):
    """Every step-th word replaced, left out, or followed by another one."""
    out = []
    for at, w in enumerate(words):
        hit = at % step == step - 1
        out += {"replace": [f"new{at}"] if hit else [w], "drop": [] if hit else [w], "insert": [w, f"new{at}"] if hit else [w]}[kind]
    return out


def test_op10_equals_brute_force_over_all_pairs(spark):
    """Every (document, item) pair whose best alignment reaches the needed score is found, and no other: items of 1 to 90
    words, every 2nd to 6th word changed, random edits, words that all items share, several copies in one text."""
    rnd = random.Random(10)
    few = [a + b for a in "abcdefgh" for b in "xyz"]
    word = lambda: rnd.choice(few) if rnd.random() < 0.5 else "".join(rnd.choice("abcdefghij") for _ in range(4))
    items = [[word() for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 8, 13, 20, 30, 40, 41, 60, 78, 90)]
    items += [items[9][:15] + [word() for _ in range(15)], ["of", "the"] * 10]
    texts = [changed(t, step, kind) for t in items for step in range(2, 7) for kind in ("replace", "drop", "insert")]
    for _ in range(60):
        words = [word() for _ in range(rnd.randint(0, 150))] + list(rnd.choice(items)) + list(rnd.choice(items))
        for _ in range(rnd.randint(0, len(words) // 2)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.randint(0, 1)] = [word()] * rnd.randint(0, 1)
            words = words or ["none"]
        texts.append(words)
    texts += [[rnd.choice(few) for _ in range(300)] for _ in range(20)] + [["of", "the"] * 200, ["of", "x", "the", "y"] * 40]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    least = lambda n: 2 * n if n < 5 else min(n, 40)
    score = {(d, i): plain_score(item, t) for d, t in enumerate(texts) for i, item in enumerate(items)}
    want = {(d, i): s / (2 * len(items[i])) for (d, i), s in score.items() if s >= least(len(items[i]))}
    assert len(want) > 300
    got = decontamination.contaminated(documents(spark, [" ".join(t) for t in texts]), bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in got} == want and len(got) == len(want)
    for r in got:
        passage = texts[r["doc_id"]][r["first_word"] : r["end_word"]]
        assert plain_score(items[r["item_id"]], passage) == round(r["score"] * 2 * len(items[r["item_id"]]))


def test_op10_segments_of_a_long_text_lose_nothing(monkeypatch):
    rnd = random.Random(4)
    words = [rnd.choice(["ab", "Cd", "什么是", "ΣΑΣ", "x_y"]) for _ in range(400)]
    text = "".join(w + rnd.choice([" ", "\n", ", "]) for w in words)
    whole = decontamination.words_of(text)
    spots = [(7, 0, 30), (8, 25, 200), (9, len(whole) - 5, len(whole) + 9)]
    monkeypatch.setattr(decontamination, "SEGMENT", 50)
    assert [w for part in decontamination.segments(text) for w in part] == whole
    assert decontamination.stretches(text, spots) == [whole[low:high] for _, low, high in spots]
    assert list(decontamination.segments(None)) == list(decontamination.segments("")) == []


def test_op10_reads_the_documents_once_whatever_the_items(spark, given):
    """A counter in the documents' plan: 10 and 1,000 items read every row once."""
    texts = [r["text"] for r in given.select("text").limit(40).collect()]
    passages = [" ".join(t.split()[at : at + 25]) for t in texts for at in range(0, 625, 25)]
    passages = [p for p in passages if len(p.split()) == 25][:1000]
    for number in (10, len(passages)):
        read = spark.sparkContext.accumulator(0)

        def count(text, read=read):
            read.add(1)
            return text

        docs = documents(spark, texts).withColumn("text", F.udf(count, "string")("text"))
        bench = spark.createDataFrame(list(enumerate(passages[:number])), "item_id long, text string")
        got = {r["item_id"] for r in decontamination.contaminated(docs, bench).collect()}
        assert len(got) == len(set(passages[:number])) and read.value == len(texts)


def test_op10_scripts_without_blanks(spark):
    """Items of one clause are found also where they are edited or stand inside a longer clause."""
    assert decontamination.words_of("GPT-4 是什么？Ünï カタ・ナ ไทย_x 한국어") == [
        "gpt", "4", "是", "什", "么", "ünï", "カ", "タ", "ナ", "ไ", "ท", "ย", "x", "한국어"
    ]
    items = ["水在标准大气压下的沸点是一百摄氏度", "日本で一番高い山は富士山です。", "เมืองหลวงของประเทศไทยคือกรุงเทพมหานคร", "光合作用发生在哪里"]
    texts = [f"他说{items[0]}对吗", items[0].replace("标准", "普通"), f"はい、{items[1]}そうです", f"ครับ{items[2]}ครับ", "今天的天气很好我们去公园散步", items[3]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontamination.contaminated(documents(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(0, 0), (1, 0), (2, 1), (3, 2), (5, 3)}


def test_op2_redact_leaves_nothing_of_overlapping_spans(spark):
    texts = [
        "write bob.4111111111111111@mail.com, or a@b.c and 1.2.3.4", "a@b.4111 1111 1111 1111 now", "4111111111111111@mail.com.",
        "none", None, "a@b.c",
    ]
    got = {r["doc_id"]: r["text"] for r in pii.redact(documents(spark, texts)).collect()}
    assert got[0] == "write [email], or [email] and [ip]"
    assert got[1] == "[email] now" and got[2] == "[email]."
    assert [got[i] for i in (3, 4, 5)] == ["none", None, "[email]"]


def test_language_floor_does_not_hang_on_labels_or_length(spark):
    """Short texts among 20 labels, and a long text in four languages of equal share, are in known languages."""
    rnd, names = random.Random(12), [f"l{i:02d}" for i in range(20)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {n: ["".join(rnd.choice(letters) for _ in range(6)) for _ in range(30)] for n in names}
    text = lambda n, k: " ".join(rnd.choice(words[n]) for _ in range(k))
    rows = [(i, text(names[i % 20], 60), names[i % 20]) for i in range(400)]
    rows += [(1000 + i, text(names[i % 20], 2), None) for i in range(20)]
    rows += [(2000, "\n".join(text(n, 40) for n in names[:4]), None), (2001, "12 !?", None), (2002, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language_id.keep_known_language(docs).where("doc_id >= 1000").collect()}
    assert kept == {*range(1000, 1020), 2000}


def test_op7_joins_only_what_may_share_a_key(spark):
    """Distant fingerprints share no key; those of one pair do, under all keys whose blocks agree."""
    fps = [simhash.fingerprint(f"text number {i} stands {i * i} alone") for i in range(400)]
    table = spark.createDataFrame([(x,) for x in {*fps, fps[0] ^ 1}], "fp long")
    listed = table.select("fp", F.explode(simhash.block_keys(F.col("fp"))).alias("k")).select("fp", F.col("k.key").alias("key"))
    sizes = listed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    got = {tuple(r) for r in simhash.likely_members(table, sizes).select("fp", "key").collect()}
    want = {tuple(r) for r in listed.join(sizes, "key").select("fp", "key").collect()}
    assert want <= got and len(want) >= 40 and len(got) < 0.02 * listed.count()

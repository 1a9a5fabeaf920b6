"""The pipeline's stages against plain Python over the smallest tables."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import sentencepiece

from saldo.llm import decontamination, language_id, piece_scan, simhash
from saldo.llm.common import table

SMALL = "/root/testdata/sf0.001"


def components(fps):
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
    return [root(i) for i in range(len(fps))]


def test_pipeline_equals_plain_python(spark):
    docs = table(spark, SMALL, "documents")
    model = language_id.learn_outside(docs)
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    told = language_id.infer([r["text"] for r in rows], model)
    rows = [r for r, (lang, score, _) in zip(rows, told, strict=True) if lang != "und" and score >= language_id.FLOOR]
    pages, held = Counter(r["source"] for r in rows), defaultdict(int)
    for r in rows:
        for line in {x.strip(" ") for x in r["text"].split("\n")} - {""}:
            held[r["source"], line] += 1
    for r in rows:
        bad = lambda x, s=r["source"]: held[s, x.strip(" ")] >= 10 and held[s, x.strip(" ")] > 0.1 * pages[s]
        r["text"] = "\n".join(x for x in r["text"].split("\n") if not bad(x))
    kept = components([simhash.fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if kept[i] == i]
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    grams = lambda t: {tuple(w[i : i + 8]) for w in [decontamination.words_of(t)] for i in range(len(w) - 7)}
    leaked = set().union(*(grams(t) for _, t in items))
    library = sentencepiece.SentencePieceProcessor(model_file=piece_scan.MODEL)
    want = {r["doc_id"]: library.encode(r["text"]) for r in rows if not grams(r["text"]) & leaked}
    got = {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == want


def test_language_stage_keeps_documents_in_several_languages(spark):
    """Halves and thirds of clean documents in different languages stay; what has no letters goes."""
    docs = table(spark, SMALL, "documents")
    rows = docs.where("length(text) between 600 and 4000").select("lang", "text").collect()
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(" ".join(r["text"].split()[:60]))
    names = sorted(by_lang)
    pairs = [f"{a}\n{b}" for x in names for y in names if x < y for a, b in list(zip(by_lang[x], by_lang[y]))[:5]]
    threes = ["\n".join(z) for z in list(zip(*(by_lang[n] for n in names[:3])))[:5]]
    texts = [*pairs, *threes, "123 !? 456", None, ""]
    more = spark.createDataFrame([(10**6 + 5 * i, t, None, "made", 0) for i, t in enumerate(texts)], docs.schema)
    kept = {r["text"] for r in language_id.keep_known_language(docs.unionByName(more)).where("source = 'made'").collect()}
    assert kept == {*pairs, *threes}


def test_stages_take_odd_rows(spark):
    """Nulls, empty texts, repeats, extra columns and an empty table pass every stage but the last with the same
    columns."""
    schema = table(spark, SMALL, "documents").schema.add("host", "string").add("row", "long")
    odd = [(1, None, None, None, None, "h", 1), (1, None, None, None, None, "h", 1), (None, "", "en", "s", 0, None, 2)]
    odd += [(i, f"the of and to in is that {i} words", "en", "s", 5, "h", 3) for i in (4, 4, 5)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "pieces" or out.columns == docs.columns
            out.collect()

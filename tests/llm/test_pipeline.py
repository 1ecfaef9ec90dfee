"""The pipeline against brute-force versions of its stages, each on what its predecessor kept."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components, plain_fingerprint

from finloom.llm.decontaminate import ENOUGH, UNITS, WINDOW, LITERALS
from finloom.llm.packing import BUCKETS, TOKEN_BUDGET, boundaries
from finloom.llm.quality import probability, features, train

SF = "/root/testdata/sf0.001"


def templated(text):
    words = re.findall(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*", text or "")
    return words, ["<num>" if w[0].isdigit() else "<unit>" if w.lower() in UNITS else
                   "<name>" if w[0] != w[0].lower() else w.lower() for w in words]


def plain_leaks(docs, items):
    table, usable = {}, Counter()
    for item, text in items:
        words, kinds = templated(text)
        for p in range(len(words) - WINDOW + 1):
            ts = tuple(kinds[p:p + WINDOW])
            if sum(t[0] != "<" for t in ts) >= LITERALS:
                table.setdefault(ts, []).append((item, p, words[p:p + WINDOW]))
                usable[item] += 1
    gone = set()
    for doc, text in docs:
        words, kinds = templated(text)
        lines = {}
        for p in range(len(words) - WINDOW + 1):
            for item, q, theirs in table.get(tuple(kinds[p:p + WINDOW]), []):
                places, slots = lines.setdefault((item, p - q), (set(), set()))
                places.add(q)
                slots |= {(k, x, y) for k, x, y in zip(kinds[p:p + WINDOW], theirs, words[p:p + WINDOW], strict=True)
                          if k[0] == "<"}
        for (item, _), (places, slots) in lines.items():
            if (len({s[:2] for s in slots}) == len(slots) == len({(k, y) for k, _, y in slots})
                    and len(places) >= min(ENOUGH, usable[item])):
                gone.add(doc)
    return gone


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_whole_pipeline(spark, documents):
    docs = {r.doc_id: r.text for r in documents.collect()}
    weights = train(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {}
    for d, text in docs.items():
        index, values = features(text)
        if probability(weights[index] @ values) >= 0.5:
            good[d] = text
    lined = {d: t for d, t in plain_lines(sorted(good.items())).items() if t == good[d] or t.strip()}
    root = plain_components({d: plain_fingerprint(t, 5) for d, t in lined.items()})
    single = {d: t for d, t in lined.items() if root[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = plain_leaks(single.items(), items)
    clean = {d: len(t.split()) for d, t in single.items() if d not in gone}
    assert len(docs) > len(good) > len(single) > len(clean) > 0 and gone
    uppers = boundaries(sorted(Counter(clean.values()).items()), BUCKETS)
    wanted, filled = set(), Counter()
    for d, n in sorted(clean.items(), key=lambda x: (x[1], x[0])):
        bucket = next(i for i, u in enumerate(uppers) if u >= n)
        room = max(1, TOKEN_BUDGET // max(1, uppers[bucket]))
        batch, slot = divmod(filled[bucket], room)
        filled[bucket] += 1
        wanted.add((d, n, bucket, uppers[bucket], batch, slot))
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == wanted


def test_stages_keep_columns_and_take_odd_rows(spark, documents):
    line = "one two three four five six seven eight nine ten"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, line, "en", "s", len(line)),
            (3, f"{line}\nand more", "en", None, len(line) + 9), (4, line, None, "s", None), (2, line, "en", "s", 50),
            (5, "w " * 50000, "en", "s", 100000)]
    odd = spark.createDataFrame(rows, documents.schema).withColumn("n_lines", F.lit("x")).withColumn(
        "Score", F.lit(None).cast("int"))
    for name, stage in corpus_pipeline.STAGES:
        for frame in (odd, odd.limit(0)):
            out = stage(spark, frame, SF)
            if name != "packing":
                assert out.columns == odd.columns and out.dtypes == odd.dtypes
            n = out.count()
            assert n <= frame.count()
    kept = {r.doc_id: r for r in corpus_pipeline.lines(spark, odd, SF).collect()}
    assert 4 not in kept and kept[3].text == "and more" and kept[3].n_chars == 8 and kept[3].n_lines == "x"
    assert kept[1].text == "" and None in kept

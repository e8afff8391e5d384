"""Sharding, decontamination, licences and toxicity."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

from fixtures import empty, frame, passage, stored, texts
from orderweave.llm import decontaminate, licenses, sharding, toxicity


def jump(key, shards):
    """The published algorithm."""
    key %= 1 << 64
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash(spark):
    from pyspark.sql import functions as F

    keys = [0, 1, -1, 2**63 - 1, -2**63, 12345678901, *range(50, 90)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 17, 1000):
        got = {r[0]: r[1] for r in df.select("k", sharding.jump_hash(F.col("k"), shards)).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_shards_of_documents(spark):
    rows = texts() + stored("documents", "doc_id + 1000, text")
    got = sharding.shard_documents(frame(spark, rows), 16).collect()
    assert len(got) == len(rows)
    places = defaultdict(list)
    for r in got:
        places[r["shard"]].append((r["doc_id"], r["slot"]))
        if r["doc_id"] is not None:
            assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], 16), jump(r["doc_id"], 17))
        assert r["grown_shard"] in (r["shard"], 16)
    for p in places.values():
        p.sort(key=lambda x: x[1])
        assert [s for _, s in p] == list(range(len(p)))
        ids = [d for d, _ in p]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sharding.shard_documents(empty(spark), 16).collect() == []


def test_keys_of_any_type(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "key string, shard int")
    got = sharding.assign_shards(df, "key", 5, "to").collect()
    assert len(got) == 4 and got[0]["to"] == got[1]["to"] and all(0 <= r["to"] < 5 for r in got)


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(words[i:i + 5]) for i in range(len(words) - 4)}


def test_items_in_documents(spark):
    items = stored("benchmark", "item_id, text") + [(900, None), (901, "too short"), (902, passage(20, 60)), (903, ""),
                                                   (None, passage(21, 20))]
    inside = passage(20, 60).split()
    rows = texts() + stored("documents", "doc_id + 1000, text") + [
        (300, passage(30, 3000) + " " + " ".join(inside).replace("e", "E") + ". " + passage(31, 2000)),
        (301, " ".join(inside[:54])), (302, " ".join(inside[:49])), (303, " ".join(inside[:30])),
        (304, " ".join(inside[:30])), (304, " ".join(inside[26:])), (305, passage(21, 20))]
    by_doc = defaultdict(set)
    for d, t in rows:
        by_doc[d] |= shingles(t)
    want = set()
    for item, text in items:
        own = shingles(text)
        for d, s in by_doc.items():
            n = len(own & s)
            if own and n >= 0.8 * len(own):
                want.add((d, item, n, len(own)))
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(frame(spark, rows), items_df)
    assert {tuple(r)[:4] for r in got.collect()} == want
    assert {d for d, *_ in want} >= {300, 301, 304, 305}
    left = decontaminate.remove_contaminated(frame(spark, rows), items_df)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(
        d for d, _ in rows if d not in {w[0] for w in want})
    assert decontaminate.find_items(empty(spark), items_df).collect() == []
    assert decontaminate.find_items(frame(spark, rows), items_df.limit(0)).collect() == []
    plan = got._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def plain_dice(text, threshold):
    grams = licenses.bigrams(text)
    best = None
    for name, template in sorted(licenses.TEMPLATES.items()):
        other = licenses.bigrams(template)
        dice = 2 * len(grams & other) / (len(grams) + len(other)) if grams else 0
        if dice >= threshold and (best is None or dice > best[1]):
            best = (name, dice)
    return best


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT-text"]
    rows = texts() + stored("documents", "doc_id + 1000, text") + [
        (50, "intro\n\n" + mit.replace(". ", ".\n") + "\n\noutro"), (51, "released under the MIT  license"), (52, "License")]
    want = Counter()
    for d, t in rows:
        for unit, position, part in licenses.units(t or ""):
            if found := plain_dice(part, 0.8):
                want[(d, unit, position, *found)] += 1
    got = Counter(tuple(r) for r in licenses.find_licenses(frame(spark, rows)).collect())
    assert got == want
    assert (50, "paragraph", 1, "MIT-text") in {k[:4] for k in want}
    assert licenses.find_licenses(empty(spark)).collect() == []


def scored(spark, rows, labels):
    return toxicity.score_documents(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()


def test_held_out_toxicity(spark):
    """Learned from four fifths, the scores tell the rest apart."""
    import duckdb

    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
    out = {d for d, _ in labels if zlib.crc32(str(d).encode()) % 5 == 0}
    got = {r["doc_id"]: r for r in scored(spark, rows, [x for x in labels if x[0] not in out])}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    truth = {d: y for d, y in labels if d in out}
    right = sum(got[d]["predicted"] == y for d, y in truth.items())
    assert right / len(truth) >= 0.95
    high = [got[d]["score"] for d, y in truth.items() if y]
    low = [got[d]["score"] for d, y in truth.items() if not y]
    assert sum(h > l for h in high for l in low) >= 0.85 * len(high) * len(low)


def test_toxicity_of_odd_tables(spark):
    rows = texts()
    got = scored(spark, rows, [(4, 1), (4, 0), (None, 1), (5, 7), (6, None)])
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in rows)
    assert {r["predicted"] for r in got} == {0}
    assert scored(spark, [], []) == []
    train = [(i, f"{passage(i, 20)} {'vile' if i % 3 == 0 else 'fine'}") for i in range(100, 200)]
    labels = [(i, int(i % 3 == 0)) for i in range(100, 180)]
    got = {r["doc_id"]: r["predicted"] for r in scored(spark, rows + train, labels) if r["doc_id"] and r["doc_id"] > 99}
    assert got == {i: int(i % 3 == 0) for i in range(100, 200)}
    left = toxicity.remove_toxic(frame(spark, train), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["doc_id"] for r in left.collect()} == {i for i in range(100, 200) if i % 3}


def test_all_labels_are_learned_from(spark):
    """A word that only documents beyond the first 20,000 labels (by hash) hold is mined, and every label counts."""
    from pyspark.sql import functions as F

    ids = [r[0] for r in spark.range(24_000).orderBy(F.xxhash64("id"), "id").collect()]
    word = {d: ("nasty" if n < 400 else "fine") if n < 20_000 else ("vile" if n < 20_400 else "fine")
            for n, d in enumerate(ids)}
    rows = [(d, f"{word[d]} {'calm' if d % 2 else 'quiet'} day number{d % 50}") for d in ids]
    labels = spark.createDataFrame([(d, int(w != "fine")) for d, w in word.items()], "doc_id long, toxic int")
    docs, known = frame(spark, rows), toxicity.usable_labels(labels)
    words = toxicity.mine_words(docs, known)
    assert set(words) == {"nasty", "vile"}
    seen = toxicity.marked(docs, words, known)
    assert {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count("*").alias("n")).collect()} == {0: 23_200, 1: 800}
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(docs, labels).collect()}
    assert got == {d: int(w != "fine") for d, w in word.items()}


def test_licenses_inside_texts(spark):
    """Licences of several paragraphs inside a long document, and notices inside a line."""
    mit = licenses.TEMPLATES["MIT-text"].replace("conditions: The", "conditions:\n\nThe").replace(
        "Software. THE", "Software.\n\nTHE")
    bsd = licenses.TEMPLATES["BSD-3-Clause"].replace("met: 1.", "met:\n\n1.").replace(" 2. ", "\n\n2. ").replace(
        " 3. ", "\n\n3. ").replace(" THIS SOFTWARE IS PROVIDED BY", "\n\nTHIS SOFTWARE IS PROVIDED BY")
    long = passage(40, 3000)
    notice = "Released under the MIT License."
    rows = [(1, f"{long}\n\n{mit}\n\n{long}"), (2, f"{long}\n\n{bsd}\n\n{long}"),
            (3, "This project is released under the MIT License."),
            (4, "Released under the MIT License. See LICENSE for details."),
            (5, f"{long} {notice} {long} {notice} {long}"), (6, notice), (7, f"{passage(41, 30)} İ {notice} {long}"),
            (8, f"{long}\n\n{mit}\n\n{long}\n\n{mit}\n\n{long}"), (9, long)]
    got = defaultdict(list)
    for r in licenses.find_licenses(frame(spark, rows)).collect():
        got[r["doc_id"]].append((r["unit"], r["position"], r["license"], round(r["dice"], 6)))
    text = dict(rows)
    second = text[5].index(notice, text[5].index(notice) + 1)
    assert {d: sorted(f) for d, f in got.items()} == {
        1: [("run", text[1].index(mit), "MIT-text", 1.0)], 2: [("run", text[2].index(bsd), "BSD-3-Clause", 1.0)],
        3: [("run", text[3].index("released"), "MIT", 1.0)], 4: [("run", 0, "MIT", 1.0)],
        5: [("run", text[5].index(notice), "MIT", 1.0), ("run", second, "MIT", 1.0)], 6: [("line", 0, "MIT", 1.0)],
        7: [("run", text[7].index(notice), "MIT", 1.0)],
        8: [("run", text[8].index(mit), "MIT-text", 1.0), ("run", text[8].rindex(mit), "MIT-text", 1.0)]}

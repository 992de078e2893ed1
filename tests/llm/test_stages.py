"""The pipeline's stages on awkward tables, and the packed sequences."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factorloom.llm import near_dups, packing, resample, url_trust

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Names of columns that the operators use inside.
INNER = (
    "good_id good bad_key bad_id key row_key row_id row_only one kept_id kept_key node part c1 c2 "
    "component id low high band size weight least label_id text_key quality q sample_key kept "
    "n_grams base spans at row piece start length bin bin_group capacity offset k1 k2 item_id "
    "n_hit n_words contaminated head n registers shard vec_id count value first last l r").split()


def awkward(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    more = [(None, "one two three four five six", "en", "s", 1), (None, None, "en", "s", 0),
            (5, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 2),
            (5, "alpha beta gamma delta epsilon zeta eta theta", "en", "s", 2),
            (5, "", None, None, None), (6, " \n", "en", "s", 2)]
    every = docs.unionByName(spark.createDataFrame(more, docs.schema))
    return every.withColumns({c: F.lit(f"x {c}") for c in INNER})


@pytest.mark.parametrize("number", range(5))
def test_stage_takes_any_columns(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    docs = awkward(spark).cache()
    out = stage(spark, docs, SF_DIR)
    rows = out.collect()
    assert rows, name
    if number < 4:
        assert out.columns == docs.columns
        plain = stage(spark, docs.drop(*INNER), SF_DIR)
        want = sorted(((r["doc_id"], r["text"]) for r in plain.collect()), key=repr)
        assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == want
        assert all(r[c] == f"x {c}" for r in rows for c in INNER)
    assert stage(spark, docs.limit(0), SF_DIR).collect() == []


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(90)}" for _ in range(n))


def test_one_row_of_each_group_stays(spark):
    a, b, c = words(1, 60), words(2, 60), words(3, 60)
    near = [a + " tail", a]
    rows = [(5, near[0]), (5, near[1]), (9, a), (None, b), (None, b + " end"), (7, c), (7, c),
            (7, c), (None, c + " x"), (8, ""), (8, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted(map(tuple, near_dups.thin(df).collect()), key=repr)
    assert [r[0] for r in left] == sorted([5, None, 7, 8, 8, None], key=repr)
    assert sum(r[1] in near for r in left) == 1 and (7, c) in left
    assert sum((r[1] or "").startswith(b) for r in left) == 1


def plain_pack(lengths, capacities, overhead=packing.OVERHEAD):
    """Best fit as one would do it by hand, bins looked through one by one."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, out = [], {}
    for place, i in enumerate(order):
        size = lengths[i]
        open_bins = [(room, n) for n, (room, _, _) in enumerate(bins) if room >= size]
        if open_bins:
            n = min(open_bins)[1]
        else:
            rest = [lengths[j] for j in order[place + 1:]]

            def price(c):
                return (c + overhead) / (size + min(
                    c - size, sum(x for x in rest if x <= c - size)))

            c = min((c for c in capacities if c >= size), key=lambda c: (price(c), -c))
            n = len(bins)
            bins.append((c, 0, []))
        room, used, items = bins[n]
        out[i] = (n, used)
        bins[n] = (room - size, used + size, items + [i])
    shrunk = [min(c for c in capacities if c >= used) for _, used, _ in bins]
    return [(*out[i], shrunk[out[i][0]]) for i in range(len(lengths))]


@pytest.mark.parametrize("seed", range(12))
def test_packing_equals_best_fit_by_hand(seed):
    rng = random.Random(seed)
    capacities = (16, 32, 64, 100)
    lengths = [rng.choice((rng.randrange(1, 101), rng.randrange(1, 20))) for _ in range(120)]
    bins, offsets, sizes = packing.pack(np.array(lengths), capacities)
    assert list(zip(bins.tolist(), offsets.tolist(), sizes.tolist())) == plain_pack(
        lengths, capacities)


def test_sequences_rebuild_every_text(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abcé ß") for _ in range(rng.choice((0, 3, 40, 90, 700)))))
             for i in range(150)] + [(200, None), (201, "x" * 5000), (None, "tail"), (3, "again")]
    texts += [(202, "same text")] * 7
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = packing.sequences(df, (32, 64, 128), group_rows=50).collect()
    found = []
    for r in rows:
        if r["bin"] is None:
            assert (r["text"], r["length"], len(r["doc_ids"])) == ("", 0, 1)
            found.append((r["doc_ids"][0], 0, ""))
            continue
        assert r["length"] == len(r["text"]) == sum(r["lengths"])
        assert r["capacity"] in (32, 64, 128) and r["padding"] == r["capacity"] - r["length"] >= 0
        assert r["offsets"] == [sum(r["lengths"][:i]) for i in range(len(r["lengths"]))]
        for who, start, at, size in zip(r["doc_ids"], r["starts"], r["offsets"], r["lengths"]):
            found.append((who, start, r["text"][at:at + size]))
    want = [(i, s, (t or "")[s:s + 128]) for i, t in texts
            for s in range(0, max(len(t or ""), 1), 128)]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert len({(r["bin_group"], r["bin"]) for r in rows if r["bin"] is not None}) == sum(
        r["bin"] is not None for r in rows)


def test_cut_keeps_as_many_labelled_texts_as_are_good(spark):
    """The cut against sorting by hand, and every row against the cut."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    sample = resample.target_sample(labels)
    scored = resample.weights(docs, sample, resample.models(docs, sample)).withColumn(
        "own", F.col("own_weight") + resample.noise(17)).cache()
    rows = scored.collect()
    quality = {}
    for r in labels.collect():
        if r["doc_id"] is not None and r["quality"] is not None:
            quality[r["doc_id"]] = min(r["quality"], quality.get(r["doc_id"], 1))
    known = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        if r["n_grams"] and r["doc_id"] in quality:
            q, v = known.get(r["text_key"], (1, r["own"]))
            known[r["text_key"]] = (min(q, quality[r["doc_id"]]), v)
    values = sorted((v for _, v in known.values()), reverse=True)
    good = sum(q for q, _ in known.values())
    cut = (values[good - 1] + values[good]) / 2
    assert resample.labelled_cut(scored, labels, 17) == pytest.approx(cut)
    kept = resample.resample(docs, labels).collect()
    assert {r["kept"] for r in kept} == {True, False}
    assert all(r["kept"] == (r["sample_key"] >= cut) for r in kept)


@pytest.mark.parametrize("html", ["<a " * 300_000, "<a href" * 150_000, "<a href=x " * 100_000,
                                  "<a href" + " " * 1_000_000, "<a " + "href =" * 160_000])
def test_long_pages_take_linear_time(spark, html):
    import time
    pages = spark.createDataFrame([("x.org", html)], "host string, html string")
    begin = time.time()
    assert url_trust.host_edges(pages).collect() == []
    assert time.time() - begin < 20


def test_links_inside_tags(spark):
    html = ('<a class="x" href="http://B.org/p">t</a><A\nHREF=\'//c.net\'>u</A> <a href = d/e>'
            '<a title="q" href=https://b.org?x><area href="http://z.org"><a data-href="http://n.o">')
    pages = spark.createDataFrame([("a.org", html)], "host string, html string")
    assert sorted(map(tuple, url_trust.host_edges(pages).collect())) == [
        ("a.org", "b.org", 2), ("a.org", "c.net", 1)]

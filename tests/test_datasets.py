import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxlake.operators import audit, dedup, leakage, splits

SIG = "output_name string, source_dataset string, sequence_group string, split string, dhash string, pixels array<double>"


def test_keep_best_and_log(spark):
    rows = [("k", "b", 3), ("k", "a", 5), ("t", "y", 1), ("t", "x", 1)]
    df = spark.createDataFrame(rows, "key string, output_name string, n_boxes long")
    assert {(r.key, r.output_name) for r in dedup.keep_best_duplicate(df).collect()} == {("k", "a"), ("t", "x")}
    log = {}
    for r in sorted(dedup.duplicate_groups(df).collect(), key=lambda r: (-r.boxes, r.file)):
        log.setdefault(r.key, (r.kept, r.kept_boxes, []))[2].append((r.file, r.boxes))
    assert log == {"k": ("a", 5, [("b", 3)]), "t": ("x", 1, [("y", 1)])}
    crop = spark.createDataFrame([("h", True, "s", "a"), ("h", True, "s", "b"), ("h", False, "s", "c"), ("h", None, "s", "d")], "d string, c boolean, s string, n string")
    assert crop.select(dedup.dedup_key("d", "c", "s", "n")).distinct().count() == 3


def test_manifest(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "file_name string") for xs in ("pq", "qr"))
    assert {tuple(r) for r in dedup.manifest_diff(a, b, ["file_name"]).collect()} == {("p", "missing"), ("r", "extra")}
    missing, extra = dedup.missing_and_extra_names(a, b, ["file_name"])
    assert missing.collect() == [("p",)] and extra.collect() == [("r",)]
    with pytest.raises(ValueError, match="1 missing, 1 extra"):
        dedup.rename_splits(a, a, b, ["file_name"])


def test_quantiles(spark):
    df = spark.createDataFrame([("one", 7.0), ("two", 0.0), ("two", 1.0), ("none", None)], "g string, v double")
    got = {(r.g, r.quantile): r.value for r in audit.quantiles(df, ["g"], ["v"]).collect()}
    assert got["one", "p01"] == got["one", "max"] == 7.0 and got["two", "p10"] == 0.1 and got["two", "p50"] == 0.5
    assert not any(g == "none" for g, _ in got)


@pytest.mark.parametrize("sketch, spread", [(20_000, 3), (40, 1), (20, 0)])  # the last misses ranks and takes brackets as wide as the values
def test_exact_quantiles_at_any_accuracy(spark, monkeypatch, sketch, spread):
    import numpy as np

    monkeypatch.setattr(audit, "SKETCH", sketch)
    monkeypatch.setattr(audit, "SPREAD", spread)
    r = random.Random(sketch)
    sets = {"even": [r.uniform(-5, 5) for _ in range(3000)], "ties": [float(r.choice([1, 1, 1, 2, 9])) for _ in range(2000)], "few": [3.0, -1.0, 7.5], "steps": [float(2**k) for k in range(40)]}
    rows = [(g, v, -v) for g, vs in sets.items() for v in vs] + [("few", None, 1.0)]
    got = {(x.g, x.metric, x.quantile): x.value for x in audit.quantiles(spark.createDataFrame(rows, "g string, a double, b double").repartition(5), ["g"], ["a", "b"]).collect()}
    for g, vs in sets.items():
        for name, f in audit.QUANTILES.items():
            assert abs(got[g, "a", name] - np.quantile(vs, f)) < 1e-6 * max(1, abs(np.quantile(vs, f)))
            more = [-v for v in vs] + ([1.0] if g == "few" else [])
            assert abs(got[g, "b", name] - np.quantile(more, f)) < 1e-6 * max(1, abs(np.quantile(more, f)))


def test_the_last_of_pictures_with_one_id_counts(spark):
    images = spark.createDataFrame([("t", 1, 100, 100, "b"), ("t", 1, 10, 10, "a"), ("t", 1, 50, 50, "c")], "split string, image_id long, width int, height int, file_name string")
    notes = spark.createDataFrame([("t", 7, 1, 1, 0.0, 0.0, 60.0, 5.0, 300.0), ("t", 8, 1, 1, -0.0005, 0.0, 6.0, 5.0, 30.0)], "split string, annotation_id long, image_id long, category_id int, x double, y double, w double, h double, area double")
    for frame in (images, images.repartition(3), images.orderBy("width")):
        got = audit.flagged(notes, frame).orderBy("annotation_id").collect()
        assert [(x.file_name, x.width, x.out_of_bounds_boxes) for x in got] == [("c", 50, True), ("c", 50, True)]
    placed = images.withColumn("position", -F.col("width"))
    assert {x.file_name for x in audit.flagged(notes, placed).collect()} == {"a"}


def test_decode_issues(spark):
    images = spark.createDataFrame([("t", "a", 10, 20), ("t", "b", 10, 20), ("t", "c", 10, 20)], "split string, file_name string, width int, height int")
    decoded = spark.createDataFrame([("t", "a", 10, 20, True), ("t", "b", 11, 20, True), ("t", "c", None, None, False)], "split string, file_name string, width int, height int, decode_ok boolean")
    assert {(r.issue, r.file_name, r.actual) for r in audit.decode_issues(images, decoded).collect()} == {("dimension_mismatches", "b", "11x20"), ("decode_errors", "c", None)}


def test_similarity_thresholds(spark):
    r = random.Random(1)
    base = [float(r.randrange(256)) for _ in range(64)]
    near = [x + (i % 2) for i, x in enumerate(base)]
    flat = [100.0 + (i % 2) for i in range(64)]
    rows = [("a", "s", "g1", "train", "h", base), ("b", "s", "g2", "test", "h", near), ("c", "s", "g1", "test", "h", near), ("d", "t", "g3", "test", "h", base), ("e", "s", "g4", "test", "h", [255 - x for x in base]), ("f", "s", "g5", "train", "h", flat), ("g", "s", "g6", "test", "h", flat)]
    df = spark.createDataFrame(rows, SIG)
    pairs = leakage.near_duplicate_pairs(df)
    assert {(r.left_output_name, r.right_output_name) for r in pairs.collect()} == {("a", "b"), ("b", "c")}
    leaks = leakage.cross_split_leak_pairs(df)
    assert {(r.left_output_name, r.right_output_name) for r in leaks.collect()} == {("a", "b")}
    assert {r.output_name: r.representative for r in leakage.picture_classes(df).collect()} == {"a": "a", "b": "b", "c": "b", "d": "d", "e": "e", "f": "f", "g": "f"}
    assert leakage.near_duplicate_pairs(df.limit(0)).count() == leakage.picture_classes(df.limit(0)).count() == 0


def test_links_of_classes_equal_brute_force(spark):
    r = random.Random(9)
    bases = [[float(r.randrange(256)) for _ in range(64)] for _ in range(4)]
    rows = []
    for i in range(120):
        x = [min(255.0, max(0.0, v + r.choice([0, 0, 6, 13, -9]) * (i % 3))) for v in bases[i % 4]] if i % 5 else bases[i % 4]
        rows.append((f"n{i:03}", f"s{i % 2}", f"g{r.randrange(9)}", r.choice(["train", "test"]), "h", x))
    rows += [(f"o{i:03}", "s0", "g1", "train", "h", rows[i][5]) for i in range(0, 60, 2)]

    def similar(a, b):
        x, y = np.array(a[5]), np.array(b[5])
        return a[1] == b[1] and min(x.std(), y.std()) >= 10 and np.corrcoef(x, y)[0, 1] >= 0.95 and abs(x - y).mean() <= 10

    df = spark.createDataFrame(rows, SIG)
    name = {(x[1], tuple(x[5])): min(y[0] for y in rows if (y[1], y[5]) == (x[1], x[5])) for x in rows}
    classes = {x[0]: name[x[1], tuple(x[5])] for x in rows}
    assert {x.output_name: x.representative for x in leakage.picture_classes(df).collect()} == classes
    by_name = {x[0]: x for x in rows}
    for column, query in ((2, leakage.near_duplicate_pairs), (3, leakage.cross_split_leak_pairs)):
        pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[column] != b[column] and similar(a, b)]
        got = [(x.left_output_name, x.right_output_name) for x in query(df).collect()]
        assert len(got) == len(set(got)) and all(by_name[a][column] != by_name[b][column] and similar(by_name[a], by_name[b]) for a, b in got)
        across = {frozenset((classes[a], classes[b])) for a, b in got if classes[a] != classes[b]}
        assert across == {frozenset((classes[a[0]], classes[b[0]])) for a, b in pairs if classes[a[0]] != classes[b[0]]}
        assert across
        for rep in set(classes.values()):
            values = {x[column] for x in rows if classes[x[0]] == rep}
            assert len([1 for a, b in got if classes[a] == classes[b] == rep]) == (len(values) - 1 if np.std(by_name[rep][5]) >= 10 else 0)


def test_components(spark):
    r = random.Random(4)
    edges = [(f"n{r.randrange(60):02}", f"n{r.randrange(60):02}") for _ in range(45)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(70)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {x: label[x] for x, y in edges if x != y} | {y: label[y] for x, y in edges if x != y}
    for parts in (1, 7):
        df = spark.createDataFrame(edges, "left_sequence_group string, right_sequence_group string").repartition(parts)
        merged = leakage.merge_groups(df)
        assert {x.sequence_group: x.merged_group for x in merged.collect()} == want
    images = spark.createDataFrame([("p070", True), ("p000", False), ("zz", False), ("yy", True)], "sequence_group string, force_train boolean")
    got = {(x.sequence_group, x.force_train) for x in leakage.propagate_force_train(images, merged).collect()}
    assert got == {("p000", True), ("zz", False), ("yy", True)}
    assert leakage.merge_groups(df.limit(0)).count() == 0
    assert {x.metric: x.value for x in leakage.merge_stats(df, merged).collect()}["pairs"] == len(edges)


def test_assignment(spark):
    tie = spark.createDataFrame([("s", "g", False, 10, 10), ("f", "h", True, 5, 5)], "source_dataset string, sequence_group string, force_train boolean, images long, boxes long")
    assert {tuple(r) for r in splits.assign_groups(tie).collect()} == {("s", "g", "train")}
    r = random.Random(5)
    rows = [("s", f"g{i}", i % 9 == 0, r.randint(1, 50), r.randint(0, 500)) for i in range(80)]
    outs = []
    for parts in (1, 4, 32):
        df = spark.createDataFrame(rows, "source_dataset string, sequence_group string, force_train boolean, images long, boxes long").repartition(parts)
        outs.append({tuple(x) for x in splits.assign_groups(df).collect()})
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) == sum(not x[2] for x in rows)
    images = {s: sum(x[3] for x in rows if (x[0], x[1], s) in outs[0] or (s == "train" and x[2])) for s in ("train", "valid", "test")}
    assert 0.7 < images["train"] / sum(images.values()) < 0.9
    with pytest.raises(ValueError):
        splits.assign_groups(tie, fractions={"train": 0.5})


def test_dense_ids(spark):
    rows = [(s, f"{s}{i}.jpg", i % 4) for s in ("train", "test") for i in range(300)]
    images = splits.dense_image_ids(spark.createDataFrame(rows, "split string, file_name string, n_boxes long").repartition(5))
    boxes = images.select("file_name", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("box_no"), F.col("n_boxes").alias("n")).filter("box_no <= n").drop("n")
    numbered = splits.dense_annotation_ids(images, boxes).collect()
    for s in ("train", "test"):
        assert sorted(r.image_id for r in images.filter(F.col("split") == s).collect()) == list(range(1, 301))
        own = sorted((r for r in numbered if r.split == s), key=lambda r: r.annotation_id)
        assert [r.annotation_id for r in own] == list(range(1, 451))
        assert [(r.image_id, r.box_no) for r in own] == sorted((r.image_id, r.box_no) for r in own)


@pytest.mark.parametrize("name", ["coco_documents", "foreign_documents"])
def test_documents_leave_only_the_tables_read_from_them(spark, name):
    import os

    from boxlake.plans import registry
    from boxlake.scratch import scratch_dir

    base = os.path.dirname(scratch_dir(spark))
    before = set(os.listdir(base))
    rows = registry.queries()[name](spark, "/root/testdata/sf0.001")
    size = lambda path: sum(os.path.getsize(os.path.join(r, f)) for r, _, files in os.walk(path) for f in files)
    left = sum(size(os.path.join(base, x)) for x in set(os.listdir(base)) - before)
    read = sum(os.path.getsize(f.removeprefix("file://")) for f in rows.inputFiles())
    assert 0 < read <= left < 1.5 * read

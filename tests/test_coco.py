import json
import random

import pytest
from pyspark.sql import functions as F

from boxlake.sources import coco, labels

NAMES = ["plain.jpg", 'quo"te.jpg', "bra}ce{.jpg", "list[0].jpg", "back\\slash\\.jpg", 'both\\"}].jpg', "unié☃.jpg", ""]


def document(seed, order):
    r = random.Random(seed)
    parts = {
        "info": {"description": 'a "quoted } text', "seed": 7, "nested": {"a": [{"id": 1}], "b": {"id": 2}}},
        "licenses": [],
        "images": [{"id": i, "file_name": f"{i}_{r.choice(NAMES)}", "width": r.choice([640, None, "x"]), "height": 480, "more": {"deep": [{"x": "}"}, {"y": "]"}]}} for i in range(r.randint(0, 6))],
        "annotations": [{"id": i, "image_id": i % 7, "category_id": 1, "bbox": r.choice([[1.5, 2, 3, 4], [1, 2], None]), "area": 12.0, "iscrowd": 0, "segmentation": [[1, 2], [3, 4]], "attributes": {"k": {"l": "{"}}} for i in range(r.randint(3, 9))],
        "categories": [{"id": 1, "name": "vehicle", "supercategory": "vehicle"}],
        "unknown": [{"id": 5}, [{"id": 6}], "text } [", 7],
    }
    return {k: parts[k] for k in order}


ORDERS = [
    ["info", "licenses", "images", "annotations", "categories", "unknown"],
    ["categories", "unknown", "annotations", "info", "images"],
    ["annotations"],
    [],
]


def plain(doc):
    num = lambda x: x if isinstance(x, int) else None
    images = sorted((i["id"], i["file_name"], num(i["width"]), i["height"]) for i in doc.get("images", []))
    box = lambda b: tuple(map(float, b)) if b and len(b) == 4 else (None,) * 4
    notes = sorted((a["id"], a["image_id"], a["area"], *box(a["bbox"])) for a in doc.get("annotations", []))
    return images, notes, [(c["id"], c["name"], c["supercategory"]) for c in doc.get("categories", [])]


def told(tables):
    images = sorted(tuple(x) for x in tables["images"].select("image_id", "file_name", "width", "height").collect())
    notes = sorted(tuple(x) for x in tables["annotations"].select("annotation_id", "image_id", "area", "x", "y", "w", "h").collect())
    return images, notes, [tuple(c) for x in tables["categories"].collect() for c in x.categories]


@pytest.mark.parametrize("size, layout", [(97, None), (150, 2), (400, None), (1 << 20, 2)])
def test_documents_in_any_ranges(spark, tmp_path, size, layout):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        docs = {f"s{k}": document(size + k, o) for k, o in enumerate(ORDERS[: 2])}
        for name, d in docs.items():
            (tmp_path / f"{name}.json").write_text(json.dumps(d, indent=layout, ensure_ascii=False), encoding="utf-8")
        for name, d in docs.items():
            assert told(coco.read_coco(spark, {name: str(tmp_path / f"{name}.json")})) == plain(d), name
        if size == 400:
            assert coco._ranges(spark, str(tmp_path / "s0.json")).select("start").distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_equals_the_reader_of_whole_documents(spark, tmp_path):
    d = document(5, ORDERS[1])
    for i in d["images"]:
        i["width"] = 640
    (tmp_path / "a.json").write_text(json.dumps(d), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(document(6, ORDERS[3])), encoding="utf-8")
    paths = {"a": str(tmp_path / "a.json"), "b": str(tmp_path / "b.json")}
    got, want = coco.read_coco(spark, paths), labels.read_coco_whole(spark, paths)
    for name, t in want.items():
        cols = sorted(t.columns)
        key = lambda rows: sorted(map(str, rows))
        assert key(got[name].select(cols).collect()) == key(t.select(cols).collect()), name


def test_parts_of_a_document(spark, tmp_path):
    d = document(9, ORDERS[0])
    lines = json.dumps(d, indent=2).splitlines(keepends=True)
    cuts = [0, *sorted(random.Random(2).sample(range(1, len(lines)), 5)), len(lines)]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / f"part-{k:05d}").write_text("".join(lines[a:b]))
    assert told(coco.read_coco(spark, {"x": str(tmp_path)})) == plain(d)


def test_structure():
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice(['"', "\\\\", '\\"', "{", "}", "[", "]", "a", "é"]) for _ in range(30)).encode()
        at, outside, step, quotes = coco.structure(text, False)
        inside, n, want, k = False, 0, [], 0
        while k < len(text):
            c = text[k : k + 1]
            if c == b"\\":
                k += 2
                continue
            if c == b'"':
                inside, n = not inside, n + 1
            elif c in b"{}[]":
                want.append((k, not inside, 1 if c in b"{[" else -1))
            k += 1
        assert quotes == n and list(zip(at.tolist(), outside.tolist(), step.tolist(), strict=True)) == want

"""Operators against small models in plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lookout.functions import boxes
from lookout.operators import detections, graph, platform, quality, ranks, report, sampling, select, sets, splits, viewpoints
from lookout.plans import pipelines

REGISTRY = "id string, folder string, camera string, split string"


def greedy(counts, n):
    counts, out = dict(counts), []
    for _ in range(n):
        total = sum(counts.values()) + 1
        short = {s: splits.TARGETS[s] - counts[s] / total for s in splits.SPLITS}
        s = max(splits.SPLITS, key=lambda x: short[x])
        counts[s] += 1
        out.append(s)
    return out


def test_greedy(spark):
    rng = random.Random(1)
    cases = [(f"c{i}", *(rng.randint(0, 12) for _ in range(3)), rng.randint(1, 40)) for i in range(50)] + [("zero", 0, 0, 0, 10)]
    rows = splits.greedy(spark.createDataFrame(cases, "camera string, train long, val long, test long, n long")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.turn):
        got.setdefault(r.camera, []).append(r.split)
    for name, t, v, e, n in cases:
        assert got[name] == greedy({"train": t, "val": v, "test": e}, n)
    assert [got["zero"].count(s) for s in splits.SPLITS] == [8, 1, 1]


def test_assign_is_stable(spark):
    empty = spark.createDataFrame([], REGISTRY)
    folders = [(f"src_cam_10_2024-01-{i:02d}T00-00-00",) for i in range(1, 16)]
    first = splits.assign(spark.createDataFrame(folders[:10], "folder string"), empty, "wf").cache()
    rows = first.collect()
    assert sorted(r.id for r in rows)[0] == "wf_00000001"
    assert sorted(r.split for r in rows).count("train") == 8
    second = splits.assign(spark.createDataFrame(folders, "folder string"), first, "wf").collect()
    assert len(second) == 5
    assert min(r.id for r in second) == "wf_00000011"


def rebalance(new, old):
    rows = [dict(r) for r in new]
    both = old + rows
    n = {s: sum(r["split"] == s for r in both) for s in splits.SPLITS}
    a, b = ("val", "test") if n["val"] > n["test"] else ("test", "val")
    count = {}
    for r in both:
        count[r["camera"], r["split"]] = count.get((r["camera"], r["split"]), 0) + 1
    order = sorted((r for r in rows if r["split"] == a), key=lambda r: (-count[r["camera"], a], r["id"]))
    left = abs(n["val"] - n["test"]) // 2
    for r in order:
        if left and count[r["camera"], a] > 1:
            r["split"] = b
            count[r["camera"], a] -= 1
            left -= 1
    return {r["id"]: r["split"] for r in rows}


@pytest.mark.parametrize("seed", range(6))
def test_rebalance(spark, seed):
    rng = random.Random(seed)
    rows = [{"id": f"wf_{i:08d}", "folder": f"f{i}", "camera": f"c{rng.randint(0, 4)}", "split": rng.choice(["train", "val", "val", "val", "test"])} for i in range(40)]
    if seed % 2:
        rows = [r | {"split": {"val": "test", "test": "val"}.get(r["split"], r["split"])} for r in rows]
    old, new = rows[:10], rows[10:]
    frame = lambda x: spark.createDataFrame([tuple(r.values()) for r in x], REGISTRY)
    assert {r.id: r.split for r in splits.rebalance(frame(new), frame(old)).collect()} == rebalance(new, old)


def test_next_id(spark):
    assert splits.next_id(spark.createDataFrame([], REGISTRY), "wf").first().next_id == 1
    assert splits.next_id(spark.createDataFrame([("wf_00000007", "", "", ""), ("fp_00000099", "", "", "")], REGISTRY), "wf").first().next_id == 8


def test_round_robin(spark):
    rng = random.Random(2)
    frames = [(f"s{rng.randint(0, 5)}", f"i{i:03d}", round(rng.random(), 1)) for i in range(60)]
    by = {}
    for f, s, c in sorted(frames, key=lambda x: (-x[2], x[1])):
        by.setdefault(f, []).append(s)
    want, turn = [], 0
    while len(want) < 25:
        want += [(f, by[f][turn]) for f in sorted(by) if turn < len(by[f])]
        turn += 1
    got = sampling.round_robin(spark.createDataFrame(frames, "folder string, stem string, score double"), 25).collect()
    assert {(r.folder, r.stem) for r in got} == set(want[:25])


def test_split_names_dont_leak(spark):
    """A camera with a split's name within its own stays in its split."""
    fp = spark.createDataFrame([("src_valbonne_1_2024-01-01T00-00-00", f"i{i}", 0, 0.5) for i in range(3)] + [(f"src_x_{i}_2024-01-01T00-00-00", "i", 0, 0.5) for i in range(9)], "folder string, stem string, line int, conf double")
    tp = spark.createDataFrame([], "folder string, stem string, n_truth int, n_predicted int, least_conf double, text string")
    rows = pipelines.training_selection(fp, tp, 2).collect()
    assert len({r.split for r in rows if "valbonne" in r.folder}) == 1
    assert sum("valbonne" in r.folder for r in rows) == 2


def test_validation(spark):
    good = "src_cam_180_2024-01-01T00-00-00"
    rows = [
        (good, [good + ".jpg"] * 3, [5, 5, 0], True, 0, 0), ("bad name", [good + ".jpg"] * 3, [5, 5, 0], False, 1, 0), ("src_cam_500_2024-01-01T00-00-00", [], [5], False, 1, 0), ("src_cam_999_2024-01-01T00-00-00", [], [5], True, 0, 0),
        (good, None, [5], False, 0, 1), (good, [good + ".jpg"], None, False, 0, 1), (good, ["IMG 1.jpg"], [5], False, 1, 0), (good, [good + ".jpg"] * 3, [], False, 0, 1), (good, [good + ".jpg"] * 3, [5, 0, 0], False, 0, 1), (good, [good + ".jpg"], [5], True, 0, 0),
    ]
    got = quality.validate(spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, folder string, images array<string>, labels array<int>")).orderBy("i").collect()
    assert [(r.is_valid, len(r.naming_issues), len(r.structural_issues)) for r in got] == [r[3:] for r in rows]


def find_components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("edges", [[(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(random.Random(i).randint(0, 60), random.Random(i + 99).randint(0, 60)) for i in range(40)], []])
def test_components(spark, edges):
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == find_components(edges)


def iou(a, b):
    w, h = (max(0.0, min(a[i + 2], b[i + 2]) - max(a[i], b[i])) for i in (0, 1))
    return w * h / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h) if w * h > 0 else 0.0


def random_boxes(n, seed):
    rng = random.Random(seed)
    return [(i, f"k{i % 3}", rng.random() * 0.3, rng.random() * 0.3, rng.choice([0.05, 0.1, 0.11, 0.3]) * (1 + rng.random() / 3), rng.choice([0.05, 0.1, 0.3])) for i in range(n)]


def test_overlap_and_suppression(spark):
    found = random_boxes(150, 3)
    df = detections.with_corners(spark.createDataFrame(found, "id long, k string, cx double, cy double, w double, h double"))
    c = {b[0]: (b[2] - b[4] / 2, b[3] - b[5] / 2, b[2] + b[4] / 2, b[3] + b[5] / 2) for b in found}
    for least in (0.7, 0.5, 0.2, 0.1, 0.05, 0.0):
        want = {(a[0], b[0]) for a in found for b in found if a[0] < b[0] and a[1] == b[1] and iou(c[a[0]], c[b[0]]) > least}
        assert {(r.a, r.b) for r in detections.overlapping(df, "k", least).collect()} == want
        assert want or least == 0.7
        assert detections.overlapping(df, "k", least).count() == len(want)
    group = {}
    for b in found:
        group.setdefault(b[1], []).append(b[0])
    scored = df.withColumns({"conf": F.col("id").cast("double"), "stem": F.lit(""), "line": F.lit(0)})
    for threshold in (0.0, 0.05, 0.1, 0.3, 0.6):
        kept = set()
        for ids in group.values():
            left = set(ids)
            for i in sorted(ids):  # confidence goes up with id here
                if any(iou(c[i], c[j]) > threshold for j in left - {i}):
                    left.discard(i)
            kept |= left
        assert {r.id for r in detections.suppress(scored, ["k"], threshold).collect()} == kept


def test_sets(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 1)], "k string, v int"), spark.createDataFrame([("x", 2)], "k string, v int")
    assert {(r.k, r.v, r.origin, r.copies) for r in sets.merge([("a", a), ("b", b)], ["k"]).collect()} == {("x", 2, "b", 2), ("y", 1, "a", 1)}
    assert sets.append(a, a).count() == 2
    left, right = sets.move(spark.createDataFrame([("fp_00000001", "f", "c", "val")], REGISTRY), spark.createDataFrame([("wf_00000004", "g", "c", "train")], REGISTRY), spark.createDataFrame([("f",)], "folder string"), "wf")
    assert left.count() == 0
    assert ("wf_00000005", "f", "c", "val") in {tuple(r) for r in right.collect()}


def test_leakage_gate(spark):
    rows = spark.createDataFrame([("a", "train"), ("a", "val"), ("b", "val"), (None, "train"), (None, "val")], "item string, split string")
    assert [tuple(r) for r in quality.leakage(rows, "item").collect()] == [("train", "val", 1)]
    with pytest.raises(ValueError, match="two splits"):
        pipelines.leakage_gate(rows, "item")
    pipelines.leakage_gate(rows.where("split = 'val'"), "item")


def test_viewpoints(spark):
    pairs = [("s", 0, 10, 50, "accepted", 10), ("s", 10, 20, 40, "accepted", 20), ("s", 100, 110, 60, "accepted", 100), ("t", 0, 5, 10, "rejected", None)]
    p = spark.createDataFrame([(s, a, b, n, 0.1, 1.0) for s, a, b, n, *_ in pairs], "site string, azimuth_a int, azimuth_b int, n_inliers int, dcx double, h_scale double")
    d = spark.createDataFrame([(f"{s}|{a}|{b}", st, k) for s, a, b, _, st, k in pairs], "pair_id string, status string, kept_azimuth int")
    reps = spark.createDataFrame([("s", a, f"t{a}", 1) for a in (0, 10, 20, 100, 110)], "site string, azimuth int, latest_timestamp string, n_sequences long")
    registry = spark.createDataFrame([("wf_1", "s_10_2024-01-01T00-00-00", "s_10", "val"), ("wf_2", "s_20_2024-01-02T00-00-00", "s_20", "train")], REGISTRY)
    rows = {(r.discard_azimuth, r.keep_azimuth, r.cluster_id, r.cluster_members, r.n_val) for r in pipelines.viewpoint_remap(p, d, reps, registry).collect()}
    assert rows == {(0, 20, "c000", "0,10,20", 0), (10, 20, "c000", "0,10,20", 1), (110, 100, "c001", "100,110", 0)}
    remap = pipelines.viewpoint_remap(p, d, reps, registry)
    assert {r.folder for r in pipelines.renamed(registry, remap, registry.select("folder")).collect()} == {"s_20_2024-01-01T00-00-00", "s_20_2024-01-02T00-00-00"}
    clash = registry.unionByName(spark.createDataFrame([("wf_3", "s_20_2024-01-01T00-00-00", "s_20", "val")], REGISTRY))
    with pytest.raises(ValueError, match="collisions"):
        pipelines.renamed(clash, remap, clash.select("folder"))
    assert viewpoints.reject_reason(p.withColumn("h_scale", F.lit(None).cast("double"))).where("reason = 'degenerate'").count() == 4


@pytest.mark.parametrize(("dcx", "scale", "inliers", "reason"), [(0.9, None, 9, "degenerate"), (0.9, None, 2, None), (0.9, float("nan"), 4, "degenerate"), (-0.51, 1.0, 0, "dcx"), (0.5, 1.71, 9, "scale"), (0.9, 0.1, 9, "dcx"), (0.0, 0.6, 9, None), (0.0, None, 3, None)])
def test_reject_reason(spark, dcx, scale, inliers, reason):
    row = spark.createDataFrame([(dcx, scale, inliers)], "dcx double, h_scale double, n_inliers int")
    assert viewpoints.reject_reason(row).first().reason == reason


def grown(box, least_w, least_h, width, height):
    """By the rule in words, side by side."""
    x1, y1, x2, y2 = box
    if x2 - x1 >= least_w and y2 - y1 >= least_h:
        return box

    def side(lo, hi, least, most):
        lo = max(0, lo - (least - (hi - lo)) // 2)
        hi = min(most, lo + least)
        if hi - lo < least:
            lo, hi = (0, min(most, least)) if lo == 0 else (max(0, most - least), most)
        return lo, hi

    (a, c), (b, d) = side(x1, x2, least_w, width), side(y1, y2, least_h, height)
    return a, b, c, d


def test_expanded(spark):
    rng = random.Random(7)
    cases = [(0, 0, 800, 600, 224, 224, 1280, 720), (10, 10, 20, 20, 224, 224, 640, 480), (600, 470, 640, 480, 224, 224, 640, 480), (0, 0, 50, 50, 224, 224, 100, 100), (100, 100, 500, 110, 224, 224, 640, 480)]
    for _ in range(200):
        w, h = rng.randint(50, 700), rng.randint(50, 700)
        x, y = sorted(rng.choices(range(w + 1), k=2)), sorted(rng.choices(range(h + 1), k=2))
        cases.append((x[0], y[0], x[1], y[1], rng.randint(1, 300), rng.randint(1, 300), w, h))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, x1 int, y1 int, x2 int, y2 int, lw int, lh int, w int, h int")
    for r in df.select("i", boxes.expanded(*map(F.col, ("x1", "y1", "x2", "y2", "lw", "lh", "w", "h"))).alias("b")).collect():
        c = cases[r.i]
        assert tuple(r.b) == grown(c[:4], *c[4:]), c


def test_homography_features(spark):
    f = lambda det: spark.range(1).select(boxes.homography_features(*map(F.lit, (0.0, 0.0, 320.0, 240.0, 640.0, 0.0, 1280.0, 480.0, 640, 480, 1280, 960)), F.lit(det)).alias("x")).first().x
    assert tuple(f(4.0)) == (0.5, 2.0, 0.25, 0.25)
    assert f(-1.0).h_scale is None


def test_validator_and_default_keep(spark):
    rows = spark.createDataFrame([("s", 1, 2, 30, "pending", "b", "a", 1, 5), ("t", 3, 4, 29, "accepted", "a", "a", 2, 2), ("t", 5, 6, 90, "accepted", "a", "b", 9, 1)], "site string, azimuth_a int, azimuth_b int, n_inliers int, status string, latest_a string, latest_b string, n_a int, n_b int")
    assert [r.azimuth_a for r in viewpoints.filtered(rows).orderBy("azimuth_a").collect()] == [1, 5]
    assert [r.azimuth_a for r in viewpoints.filtered(rows, 0, "accepted", "t").orderBy("azimuth_a").collect()] == [3, 5]
    assert [r.proposed for r in viewpoints.default_keep(rows).orderBy("azimuth_a").collect()] == [1, 3, 6]
    totals = viewpoints.remap_totals(spark.createDataFrame([], "cluster_id string, n_sequences long, n_train long, n_val long, n_test long")).first()
    assert tuple(totals) == (0, 0, 0, 0, 0, 0)


@pytest.mark.parametrize("values", [["b", "a", "ab", "abc", "abcd", "abcd", "", "é", "aéz", None], [f"wf_{i:08d}" for i in range(57)], ["same"] * 9, []])
def test_nth_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    order = sorted((v for v in values if v is not None), key=lambda v: v.encode())
    for n in {1, 2, 5, len(order), len(order) + 1} - {0}:
        assert ranks.nth_text(df, "x", n) == (order[n - 1] if n <= len(order) else None)


def test_by_ratio(spark):
    rng = random.Random(8)
    rows = [(f"i{i:04d}", rng.choice(["train", "train", "val", None])) for i in range(500)] + [("one", "test")]
    got = sampling.by_ratio(spark.createDataFrame(rows, "stem string, split string"), ["split"], 0.05, seed=3).collect()
    want = set()
    for s in ("train", "val", "test", None):
        own = sorted((x for x, y in rows if y == s), key=lambda x: (hashlib.md5(f"3|{x}".encode()).hexdigest(), x))
        want |= {(x, s) for x in own[: max(1, round(len(own) * 0.05))]}
    assert {(r.stem, r.split) for r in got} == want
    assert len(got[0]) == 2


def test_prediction_truth(spark):
    p = spark.createDataFrame([("f", "a", "0 .5 .5 .1 .1 .9\n0 .5 .5 .1 .1 .3"), ("f", "b", ""), ("f", "c", None)], "folder string, stem string, text string")
    t = spark.createDataFrame([("f", "a", "0 .5 .5 .1 .1"), ("f", "b", "")], "folder string, stem string, text string")
    rows = {r.stem: (r.n_truth, r.n_predicted, r.least_conf, r.text) for r in sampling.prediction_truth(p, t).collect()}
    assert rows == {"a": (1, 2, 0.3, "0 .5 .5 .1 .1"), "b": (0, 0, None, ""), "c": (0, 0, None, None)}
    assert sampling.prediction_truth(p.where("stem <> 'c'"), t, strict=True).count() == 2
    with pytest.raises(Exception, match="no ground truth"):
        sampling.prediction_truth(p, t, strict=True).collect()


def test_counters(spark):
    registry = spark.createDataFrame([("a", "train"), ("b", "train"), ("c", "val")], "folder string, split string")
    images = spark.createDataFrame([("a",), ("a",), ("b",)], "folder string")
    chosen = spark.createDataFrame([("a", "1")], "folder string, stem string")
    got = {r.split: (r.sequences, r.written, r.frames, r.skipped, r.missing) for r in quality.run_counters(registry, images, chosen).collect()}
    assert got == {"train": (2, 1, 1, 1, 0), "val": (1, 0, 0, 0, 1)}
    rows, seen = quality.observed(images, "build", of_a=F.col("folder") == "a")
    assert rows.count() == 3
    assert seen.get == {"rows": 3, "of_a": 2}
    split = registry.select("split")
    with pytest.raises(ValueError, match="differ"):
        quality.assert_parity(split, split.limit(1))
    quality.assert_parity(split, split)
    assert {r.split: r.n for r in sampling.split_counts(registry).collect()} == {"train": 2, "val": 1, "test": 0}


def test_two_stage(spark):
    rng = random.Random(4)
    items = [(i, f"f{i}", f"c{i % 3}", [rng.gauss(0, 1) for _ in range(8)]) for i in range(40)]
    df = spark.createDataFrame(items, "id long, folder string, camera string, embedding array<double>")
    boxes = spark.createDataFrame([(f"f{i}", "a", 0, 0.5, 0.5, 0.5, 0.2, 0.2) for i in range(10)], "folder string, stem string, line int, conf double, cx double, cy double, w double, h double")
    got = select.two_stage(df, boxes, 6, restarts=2).collect()
    assert 0 < len(got) <= 6
    assert len({r.id for r in got}) == len(got)
    assert select.two_stage(df, boxes, 0).count() == 0
    assert select.two_stage(df, boxes, 100).count() == 33  # ten items in three atoms, and thirty alone


def test_two_stage_select_restarts(spark, monkeypatch):
    from lookout.plans import queries

    monkeypatch.setattr(queries, "proxy", lambda *a: spark.createDataFrame([("f1",)], "folder string"))
    seen = {}
    monkeypatch.setattr(select, "two_stage", lambda items, boxes, quota, match_iou=0.7, seed=0, restarts=10: seen.update(restarts=restarts))
    queries.QUERIES["two_stage_select"](spark, "")
    assert seen == {"restarts": 10}


def test_assign(spark):
    rng = random.Random(6)
    v = {i: [rng.gauss(0, 1) for _ in range(4)] for i in range(30)}
    c = {"a": [1.0, 0.0, 0.0, 0.0], "b": [0.0, 1.0, 0.0, 0.0], "c": [0.0, 1.0, 0.0, 0.0]}
    df, centres = spark.createDataFrame(list(v.items()), "id long, embedding array<double>"), spark.createDataFrame(list(c.items()), "label string, centroid array<double>")
    got = {r.id: r.label for r in select.assign(df, centres, "label", "id").collect()}
    assert got == {i: "a" if round(x[0], 9) >= round(x[1], 9) else "b" for i, x in v.items()}


def test_nearest(spark):
    rng = random.Random(5)
    v = {i: [float(rng.randint(0, 3)) for _ in range(3)] for i in range(60)}
    df = spark.createDataFrame(list(v.items()), "id long, embedding array<double>")
    got = {(r.query, r["rank"]): r.neighbour for r in select.nearest(df.where("id % 7 = 0"), df, 3, most_queries=4).collect()}
    for q in range(0, 60, 7):
        want = sorted((round(sum((a - b) ** 2 for a, b in zip(v[q], v[i])) ** 0.5, 9), i) for i in v if i != q)[:3]
        assert [got[q, k] for k in (1, 2, 3)] == [i for _, i in want]


def test_platform(spark):
    none = F.lit(None).cast("string")
    d = spark.createDataFrame([(1, 5)], "id long, sequence_id long").withColumns({c: none for c in ("created_at", "azimuth", "url", "bboxes", "bucket_key")})
    s = spark.createDataFrame([(5, 7, True), (5, 7, True)], "id long, camera_id long, is_wildfire boolean").withColumns({c: none for c in ("started_at", "last_seen_at", "azimuth")})
    c = spark.createDataFrame([(7, 9, "cam")], "id long, organization_id long, name string").withColumns({x: none for x in ("lat", "lon", "is_trustable", "angle_of_view")})
    o = spark.createDataFrame([(9, "org")], "id long, name string")
    (r,) = platform.records(d, s, c, o).collect()
    assert (r.sequence_is_wildfire, r.camera_name, r.organization_name) == (True, "cam", "org")
    assert len(r) == 19
    twice = c.unionByName(c.withColumn("name", F.lit("new")))
    at = twice.withColumn("at", F.when(F.col("name") == "new", 1).otherwise(2))
    assert platform.records(d, s, platform.last_of(at, "at"), o).first().camera_name == "cam"
    assert platform.records(d, s, twice, o).first().camera_name == "new"
    assert platform.records(d, s, c, o, strict=True).count() == 1
    assert platform.records(d, s, c.limit(0), o).count() == 0
    with pytest.raises(Exception, match="no camera_id 7"):
        platform.records(d, s, c.limit(0), o, strict=True).collect()
    known = platform.records(d, s, c, o)
    assert pipelines.platform_update(known, d, s, c, o).count() == 1
    dirs = spark.createDataFrame([("a/x-true-positives/",), ("a/false-positives",), ("b/c_sequence-7",), ("b/c_sequence-7x",)], "path string")
    assert [platform.directories(dirs, e).count() for e in ("true-positives", "false-positives")] == [1, 1]
    assert [r.path for r in platform.directories(dirs, sequence=True).collect()] == ["b/c_sequence-7"]
    ids = platform.sequence_ids(spark.createDataFrame([("x_sequence-12",), ("x_sequence-",), ("y",)], "folder string"))
    assert [r.sequence_id for r in ids.collect()] == [12]


def test_reports(spark):
    rows = spark.createDataFrame([("train", "a"), ("train", "b"), ("val", "a")], "split string, source string")
    got = {r.source: (r.train, r.val, r.test, r.total) for r in report.breakdown(rows, "source").collect()}
    assert got == {"a": (0.5, 1.0, 0.0, 2), "b": (0.5, 0.0, 0.0, 1)}
    assert report.background_ratio(spark.createDataFrame([], "split string, is_background boolean")).count() == 0


def test_prediction_truth_parses_a_text_once(spark):
    """The texts of predictions and of truths are parsed once each, without patterns that are compiled for every value."""
    p = spark.createDataFrame([("f", "a", "0 .5\t.5  .1 .1 .9\r\n\n \t\r\n0 .5 .5 .1 .1 .3 \n1 2 3 4")], "folder string, stem string, text string")
    t = spark.createDataFrame([("f", "a", "\t0 .5 .5 .1 .1\x0b\r\n0 .5 .5 0 .1")], "folder string, stem string, text string")
    found = sampling.prediction_truth(p, t)
    assert [(r.n_truth, r.n_predicted, r.least_conf) for r in found.collect()] == [(1, 2, 0.3)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 4 and "\\s" not in plan

"""Operators held to values worked out in another way, and to their errors."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinoframe import plans
from kinoframe.operators import publish, series, skeleton, vectors
from kinoframe.sources import readers, synthetic
from kinoframe.streaming import jobs

from .compare import SF_DIR

PARENTS = [-1, 0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 12, 13, 14, 16, 17, 18, 19, 20, 21]


def turned(r):
    """Rotation matrix by the exponential's series."""
    k = np.array([[0, -r[2], r[1]], [r[2], 0, -r[0]], [-r[1], r[0], 0]])
    out, term = np.eye(3), np.eye(3)
    for n in range(1, 40):
        term = term @ k / n
        out = out + term
    return out


@pytest.mark.parametrize("n", [3, 5, 20, 128, 300])
def test_variational_smooth(spark, n):
    x = np.cumsum(np.random.default_rng(n).standard_normal(n))
    df = spark.createDataFrame([("u", i, float(v)) for i, v in enumerate(x)], "u string, i int, v double")
    got = [r[0] for r in series.variational_smooth(df, "u", ["i"], "v", 10.0, 64).orderBy("i").select("smooth").collect()]
    if n < 5:
        assert got == x.tolist()
        return
    w = min(64, n)
    d = np.zeros((w - 2, w))
    for k in range(w - 2):
        d[k, k : k + 3] = (1, -2, 1)
    total, weight = np.zeros(n), np.zeros(n)
    for s in sorted({*range(0, n - w + 1, w // 2), n - w}):
        t = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(w) / (w - 1)) + 1e-6
        total[s : s + w] += t * np.linalg.solve(np.eye(w) + 10 * d.T @ d, x[s : s + w])
        weight[s : s + w] += t
    assert np.allclose(got, total / weight)


def test_spanning_tree(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([c + 0.1 * rng.standard_normal((90, 3)) for c in ((0, 0, 0), (9, 0, 0), (0, 9, 9))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = dict(map(tuple, vectors.spanning_tree_labels(df, "id", "v", tile=50).collect()))
    assert [got[i] for i in range(270)] == [i // 90 for i in range(270)]
    one = vectors.spanning_tree_labels(df.filter("id < 90"), "id", "v", min_gap=50.0).collect()
    assert {r["cluster"] for r in one} == {0}
    assert vectors.spanning_tree_labels(df.filter("id = 3"), "id", "v").collect() == [(3, 0)]


def test_mst_people(spark):
    """Single linkage by joining the nearest clusters until the jump."""
    rows = plans.QUERIES["mst_people"](spark, SF_DIR).collect()
    points = {r[0]: np.array(r[1:]) for r in spark.read.parquet(f"{SF_DIR}/customer.parquet").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("c")).join(
        spark.read.parquet(f"{SF_DIR}/supplier.parquet").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.avg("s_acctbal").alias("s")), "c_nationkey").select("c_nationkey", "c", "s").collect()}
    groups, joins = [{k} for k in sorted(points)], []
    while len(groups) > 1:
        d, a, b = min((min(np.linalg.norm(points[p] - points[q]) for p in g for q in h), i, j) for i, g in enumerate(groups) for j, h in enumerate(groups) if i < j)
        joins.append((d, [set(g) for g in groups]))
        groups[a] |= groups.pop(b)
    sizes = [d for d, _ in joins]
    ratio = [b / max(a, 1e-12) for a, b in zip(sizes, sizes[1:])]
    cut = [set(points)] if not ratio or max(ratio) < 1.5 else joins[int(np.argmax(ratio)) + 1][1]
    got = {}
    for r in rows:
        got.setdefault(r["cluster"], set()).add(r["nation"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, cut))


def test_routes_of_clustering(spark):
    e = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    few = vectors.cluster_labels(e, "vec_id", "embedding", 4)
    assert few.count() == e.count() and {r["cluster"] for r in few.collect()} <= set(range(4))
    some = e.filter("vec_id < 40")
    assert sorted(vectors.cluster_labels(some, "vec_id", "embedding").collect()) == sorted(vectors.spanning_tree_labels(some, "vec_id", "embedding").collect())


def test_global_rotations(spark):
    pose = np.random.default_rng(1).normal(0, 0.7, (5, 24, 3))
    df = spark.createDataFrame([(i, p.ravel().tolist()) for i, p in enumerate(pose)], "i int, pose array<double>")
    got = {r["i"]: np.array(r["global_rotation"]).reshape(24, 3, 3) for r in skeleton.global_rotations(df, "pose").collect()}
    for i, p in enumerate(pose):
        for j in range(24):
            want, k = np.eye(3), j
            while k >= 0:
                want, k = turned(p[k]) @ want, PARENTS[k]
            assert np.allclose(got[i][j], want)


def test_retarget_config(spark):
    config = json.loads(plans.QUERIES["retarget_config"](spark, SF_DIR).first()["config"])
    assert config["bone_map"]["L_Knee"] == "mixamorig:LeftLeg" and config["bone_map"]["L_Hand"] is None
    assert config["unmapped"] == ["L_Hand", "R_Hand"] and len(config["parents"]) == 24
    assert config["parents"]["Pelvis"] is None and config["parents"]["Head"] == "Neck"
    nations = {r["n_nationkey"]: r["n_regionkey"] for r in spark.read.parquet(f"{SF_DIR}/nation.parquet").collect()}
    place = lambda j: np.array([j * 0.5, nations[j] * 0.25, 1.0])
    for j in (5, 15, 23):
        d = place(j) - place(PARENTS[j])
        assert config["rest_offsets_m"][skeleton.JOINTS[j]] == pytest.approx(d) and config["rest_lengths_m"][skeleton.JOINTS[j]] == pytest.approx(np.linalg.norm(d))


def test_motion_capture_text(spark):
    rng = np.random.default_rng(2)
    pose, trans = rng.normal(0, 0.4, (3, 72)), rng.normal(0, 1, (3, 3))
    offsets = {n: [0.1 * j, 0.2, 0.3] for j, n in enumerate(skeleton.JOINTS)}
    df = spark.createDataFrame([("u", i, pose[i].tolist(), trans[i].tolist()) for i in range(3)], "u string, f int, pose array<double>, trans array<double>")
    text = skeleton.bvh_text(df, "u", "f", "pose", "trans", offsets, 20.0).first()["text"]
    head, lines = text.split("MOTION\n")
    rows = lines.strip().split("\n")
    assert rows[:2] == ["Frames: 3", "Frame Time: 0.05000000"] and len(rows) == 5
    names = [x.split()[1] for x in head.split("\n") if x.strip().startswith(("ROOT", "JOINT"))]
    assert names[:6] == ["Pelvis", "L_Hip", "L_Knee", "L_Ankle", "L_Foot", "R_Hip"] and sorted(names) == sorted(skeleton.JOINTS)
    assert head.count("{") == head.count("}") == 24 + head.count("End Site") and head.count("CHANNELS 6") == 1
    for i, line in enumerate(rows[2:]):
        v = np.array(line.split(), float)
        assert np.allclose(v[:3], 100 * trans[i], atol=1e-5)
        for k, n in enumerate(names):
            z, y, x = np.radians(v[3 + 3 * k : 6 + 3 * k])
            made = turned((0, 0, z)) @ turned((0, y, 0)) @ turned((x, 0, 0))
            j = skeleton.JOINTS.index(n)
            assert np.allclose(made, turned(pose[i][3 * j : 3 * j + 3]), atol=1e-5)


def test_feature_joints_are_moved_with_the_root(spark):
    vector = [0.3, 0.5, 0.2, 0.9] + [0.1] * 63
    df = spark.createDataFrame([("u", i, vector) for i in range(3)], "u string, f int, v array<double>")
    got = {(r["f"], r["joint"]): np.array([r["x"], r["y"], r["z"]]) for r in skeleton.feature_joints(df, "u", "f", "v").collect()}
    assert len(got) == 3 * 22 and np.allclose(got[0, 0], (0, 0.9, 0))
    for f in (1, 2):  # turning about the upright axis keeps heights, and distances from the root
        assert got[f, 5][1] == pytest.approx(0.1)
        assert np.hypot(*(got[f, 5] - got[f, 0])[[0, 2]]) == pytest.approx(np.hypot(0.1, 0.1))


def test_what_is_missing(spark, tmp_path):
    for read in (lambda p: readers.scan_files(spark, p, [".mp4"]), lambda p: readers.read_manifest(spark, p), lambda p: readers.read_index(spark, p)):
        with pytest.raises(FileNotFoundError):
            read(f"{tmp_path}/none")
    assert readers.read_registry(spark, f"{tmp_path}/none").count() == readers.read_labels(spark, f"{tmp_path}/none").count() == readers.read_segments(spark, f"{tmp_path}/none").count() == 0
    assert readers.read_metrics(spark, "momask", str(tmp_path)) is None and readers.read_metrics(spark, "mdm", str(tmp_path)) is None
    with pytest.raises(Exception, match="no c_custkey -5"):
        readers.lookup(spark.read.parquet(f"{SF_DIR}/customer.parquet"), "c_custkey", -5).collect()
    with pytest.raises(Exception, match="as many captions"):
        publish.zipped(spark.createDataFrame([([1.0, 2.0], ["a"])], "t array<double>, c array<string>"), "t", "c").collect()
    (tmp_path / "progress.csv").write_text("step,loss\n1,2\n")
    with pytest.raises(ValueError, match="held-out"):
        readers.read_progress(spark, f"{tmp_path}/progress.csv")


def test_files_as_other_tools_write_them(spark, tmp_path):
    (tmp_path / "videos/cam01/a").mkdir(parents=True)
    for name in ("cam01/a/x.MP4", "cam01/y.mov", "z.mp4", "cam01/no.txt"):
        (tmp_path / "videos" / name).write_bytes(b"1234")
    found = readers.scan_files(spark, f"{tmp_path}/videos", [".mp4", ".mov"]).collect()
    assert [(r["rel_path"], r["camera"], r["length"]) for r in found] == [("cam01/a/x.MP4", "cam01", 4), ("cam01/y.mov", "cam01", 4), ("z.mp4", "cam", 4)]
    assert "camera" not in readers.scan_videos(spark, f"{tmp_path}/videos", [".mp4"]).columns
    (tmp_path / "manifest.json").write_text(json.dumps({"footage_root": "/f", "clips": [{"clip_id": "a", "status": "pending"}, {"clip_id": "b", "status": "done", "tracks": [{"track_id": "t0", "n_frames": 3}]}]}, indent=2))
    clips = {r["clip_id"]: r for r in readers.read_manifest(spark, f"{tmp_path}/manifest.json").collect()}
    assert clips["a"]["tracks"] == [] and clips["b"]["tracks"][0]["n_frames"] == 3 and clips["a"]["note"] is None
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels/v1.json").write_text(json.dumps({"0": {"description": "d", "tags": ["x"]}, "10": {"description": "e"}}))
    assert sorted((r["video_id"], r["seg_index"], r["tags"]) for r in readers.read_labels(spark, f"{tmp_path}/labels").collect()) == [("v1", 0, ["x"]), ("v1", 10, [])]
    (tmp_path / "segments").mkdir()
    (tmp_path / "segments/v1.json").write_text(json.dumps({"segments": [{"index": 0, "start": 0.0, "end": 2.5}]}))
    assert readers.read_segments(spark, f"{tmp_path}/segments").collect() == [("v1", 0, 0.0, 2.5)]
    (tmp_path / "index.json").write_text(json.dumps({"clips": [{"clip_id": "a", "n_frames": 3, "fps": 20.0, "split": "val"}]}))
    assert readers.read_index(spark, str(tmp_path)).first()["n_frames"] == 3
    (tmp_path / "metrics.jsonl").write_text('{"step": 1, "train_loss": 2.0}\n{"step": 100.0, "train_loss": 1.0, "val_loss": 0.5}\n')
    assert readers.read_metrics(spark, "noop", str(tmp_path)).collect() == [(100, 1.0, 0.5)]
    (tmp_path / "m.csv").write_text("step,loss,grad_norm,eval_loss\n0,1,1,0.9\n250,1,1,\n300,0.5,1,0.7\n")
    assert [r["step"] for r in readers.read_progress(spark, f"{tmp_path}/m.csv").collect()] == [0, 300]


def test_archives(spark, tmp_path):
    rng = np.random.default_rng(0)
    poses, left = rng.normal(size=(4, 72)).astype(np.float32), rng.normal(size=(4, 45)).astype(np.float32)
    (tmp_path / "pose").mkdir()
    np.savez(tmp_path / "pose/clip_1.npz", poses=poses, trans=np.zeros((4, 3)), fps=np.float32(20), frame="global", left_hand_pose=left, right_hand_pose=np.zeros((4, 45)), has_left=np.bool_(True), has_right=np.bool_(False))
    rows = sorted(readers.read_motion(spark, f"{tmp_path}/pose").collect(), key=lambda r: r["frame_idx"])
    assert [r["unit_id"] for r in rows] == ["clip_1"] * 4 and rows[0]["right_hand"] is None and rows[0]["frame"] == "global"
    assert np.allclose([r["pose"] for r in rows], poses) and np.allclose([r["left_hand"] for r in rows], left)
    out = publish.export_frames(readers.read_motion(spark, f"{tmp_path}/pose").withColumns({c: F.col(c).cast("array<double>") for c in ("pose", "left_hand", "right_hand")}))
    assert {len(r["poses"]) for r in out.collect()} == {156} and "left_hand" not in out.columns
    with pytest.raises(Exception, match="world coordinates"):
        publish.export_frames(readers.read_motion(spark, f"{tmp_path}/pose").withColumn("frame", F.lit("incam")).withColumns({c: F.col(c).cast("array<double>") for c in ("pose", "left_hand", "right_hand")})).collect()
    (tmp_path / "mesh").mkdir()
    np.savez(tmp_path / "mesh/box.npz", vertices=np.arange(12.0).reshape(4, 3))
    assert sorted(map(tuple, readers.read_vertices(spark, f"{tmp_path}/mesh").collect()))[1] == ("box", 1, 3.0, 4.0, 5.0)


def test_made_up_shapes_are_the_persons(spark):
    df = spark.range(4).select((F.col("id") % 2).alias("p")).withColumn("s", synthetic.synthetic_shape(F.col("p")))
    shapes = {(r["p"], tuple(r["s"])) for r in df.collect()}
    assert len(shapes) == 2 and all(len(s) == 10 and max(map(abs, s)) <= 1 for _, s in shapes)


def test_picks_take_the_whole_digest(spark):
    import hashlib

    keys = [f"clip{i}.mp4:0.500s" for i in range(20)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", synthetic.pick(F.col("k"), synthetic.SUBJECTS).alias("w"))
    assert all(r["w"] == synthetic.SUBJECTS[int(hashlib.sha1(r["k"].encode()).hexdigest(), 16) % 7] for r in df.collect())


def test_new_files_and_curves(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.bin").write_bytes(b"xyz")
    q = jobs.new_files(spark, f"{tmp_path}/in").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c1").option("path", f"{tmp_path}/seen").trigger(availableNow=True)
    q.start().awaitTermination()
    (tmp_path / "in/b.bin").write_bytes(b"1")
    q.start().awaitTermination()
    assert sorted(r["length"] for r in spark.read.parquet(f"{tmp_path}/seen").collect()) == [1, 3]
    (tmp_path / "runs").mkdir()
    curve = [1.0, 0.7, 0.5, 0.45, 0.5, 0.6, 0.72, 0.8, 0.9]
    (tmp_path / "runs/r.csv").write_text("run,step,train_loss,val_loss\n" + "".join(f"r,{100 * i},0.1,{v}\n" for i, v in enumerate(curve)))
    stopped = []
    query = jobs.monitor_curve(spark, f"{tmp_path}/runs", f"{tmp_path}/watch", 5, stopped.append).start()
    try:
        for _ in range(60):
            if stopped:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert stopped and stopped[0]["onset_step"] == 300


def test_leases_come_back(spark, tmp_path):
    (tmp_path / "l").mkdir()
    df = spark.createDataFrame([("a", "in_progress"), ("b", "done")], "clip_id string, status string")
    df.write.parquet(f"{tmp_path}/l/1")
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/l")
    query = jobs.release_on_timeout(stream, 1500).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/o").trigger(processingTime="500 milliseconds").start()
    try:
        rows = []
        for _ in range(60):
            time.sleep(0.5)
            rows = [tuple(r) for r in spark.read.schema("clip_id string, status string").parquet(f"{tmp_path}/o").collect()] if (tmp_path / "o").exists() else []
            if ("a", "pending") in rows:
                break
    finally:
        query.stop()
    assert sorted(rows) == [("a", "in_progress"), ("a", "pending"), ("b", "done")]


def test_feature_root_sorts_no_vectors(spark):
    """The root alone is joint 0 of all, and neither joints nor vectors are in its plan."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i % 2, i, rng.normal(size=67).tolist()) for i in range(20)], "u int, f int, v array<double>")
    want = {tuple(r) for r in skeleton.feature_joints(df, "u", "f", "v").filter("joint = 0").drop("joint").collect()}
    assert {tuple(r) for r in skeleton.feature_root(df, "u", "f", "v").collect()} == want and len(want) == 20
    plan = plans.QUERIES["feature_root"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Union" not in plan and "array_repeat" not in plan

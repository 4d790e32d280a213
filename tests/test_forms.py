"""Every estimator's form gives the motion that was put into it."""

import duckdb
import numpy as np
import pytest

from kinoframe import plans
from kinoframe.operators import estimates


def matrices(v):
    out = []
    for r in np.asarray(v, float).reshape(-1, 3):
        a = np.linalg.norm(r)
        x, y, z = r / (a or 1)
        k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
        out.append(np.eye(3) + np.sin(a) * k + (1 - np.cos(a)) * k @ k)
    return np.array(out).ravel().tolist()


RNG = np.random.default_rng(7)
POSE, HANDS, TRANS = RNG.uniform(-0.8, 0.8, (4, 72)), RNG.uniform(-0.8, 0.8, (4, 90)), RNG.uniform(-3, 3, (4, 3))
REST = np.concatenate([POSE[:, :66], np.zeros((4, 6))], 1)


def forms(k):
    """(method, columns of frame k, pose, place, hands)."""
    p, h, t = POSE[k], HANDS[k], TRANS[k].tolist()
    all55 = np.concatenate([p[:66], np.zeros(9), h])
    return [
        ("gvhmr", {"global_orient": p[:3].tolist(), "body_pose": p[3:66].tolist(), "transl": t}, REST[k], t, None),
        ("wham", {"pose_world": p.tolist(), "pose": [0.0] * 72, "trans_world": t, "trans": [0.0] * 3}, p, t, None),
        ("tram", {"pred_rotmat": matrices(p), "pred_trans": t}, p, t, None),
        ("4dhumans", {"global_orient": matrices(p[:3]), "body_pose": matrices(p[3:])}, p, [0, 0, 0], None),
        ("hybrik", {"pred_thetas": matrices(all55), "transl": t}, REST[k], t, h),
        ("smplx_frames", {"root_pose": p[:3].tolist(), "body_pose": p[3:66].tolist(), "cam_trans": t, "left_hand_pose": h[:45].tolist(), "rhand_pose": matrices(h[45:])}, REST[k], t, h),
    ]


@pytest.mark.parametrize("at", range(6))
def test_form(spark, at):
    rows = [("u", 10 * k, "b", *forms(k)[at][1].values()) for k in (2, 0, 3, 1)]
    method, columns = forms(0)[at][0], list(forms(0)[at][1])
    if estimates.FORMS[method].subject != "only":
        rows += [("u", 10 * k, "a", *forms(3 - k)[at][1].values()) for k in range(3)]
    df = spark.createDataFrame(rows, f"unit string, frame long, track string, {', '.join(f'{c} array<double>' for c in columns)}")
    got = sorted(estimates.motion_of(method.upper(), df, "unit", "frame", "track").collect(), key=lambda r: r["frame_idx"])
    assert [r["frame_idx"] for r in got] == [0, 1, 2, 3]
    for k, r in enumerate(got):
        *_, pose, trans, hands = forms(k)[at]
        assert np.allclose(r["pose"], pose, atol=1e-6) and np.allclose(r["trans"], trans)
        assert (r["left_hand"] is None and r["right_hand"] is None) if hands is None else np.allclose([*r["left_hand"], *r["right_hand"]], hands, atol=1e-6)


def test_errors(spark):
    df = spark.createDataFrame([("u", 0, [0.0] * 72, [0.0] * 3), ("u", 0, [0.0] * 72, [0.0] * 3)], "unit string, frame long, pred_thetas array<double>, transl array<double>")
    with pytest.raises(ValueError, match="no form"):
        estimates.motion_of("nothing", df, "unit", "frame")
    with pytest.raises(ValueError, match="no pose"):
        estimates.motion_of("wham", df, "unit", "frame")
    with pytest.raises(Exception, match="72 numbers for 55 joints"):
        estimates.motion_of("hybrik", df, "unit", "frame").collect()
    two = df.selectExpr("unit", "frame", "slice(pred_thetas, 1, 3) AS root_pose", "slice(pred_thetas, 1, 63) AS body_pose")
    with pytest.raises(Exception, match="2 smplx_frames detections"):
        estimates.motion_of("smplx_frames", two, "unit", "frame").collect()


def test_tiny_numbers_keep_their_sign(spark, tmp_path):
    """What rounds to nothing keeps its sign as in SQL, a zero is positive, and a half worked out by matrices goes up."""
    base = [0.01 * (k + 1) for k in range(64)]
    rows = [(i, 1, [-4e-6 if k in (i, 18) else 0.0 if k in (i + 1, 21) else 0.015625 if k == 24 else v for k, v in enumerate(base)]) for i in range(12)]
    spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("estimator_forms", "assembled_pose", "hands_and_masks", "wrist_round_trip"):
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = connection.execute(plans.ORACLE_SQL[name])
        names = [c[0] for c in want.description]
        got = plans.QUERIES[name](spark, str(tmp_path)).select(*names).collect()
        assert sorted(repr(tuple(r)) for r in got) == sorted(repr(r) for r in want.fetchall()), name

"""Quantization against error bounds and a plain NumPy statement of the rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactmill import fixed_values as fv
from pactmill.functions import blocks as bl
from pactmill.operators import vectors

rng = np.random.default_rng(3)


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(700):
        size = 70 if i % 5 == 0 else 64
        v = rng.normal(size=size).astype("float32") * (1 + i % 3)
        if i == 10:
            v[:] = 0
        if i == 11:
            v[32:64] = 0
        rows.append((i * 2, [float(x) for x in v] if i != 12 else []))
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)


@pytest.mark.parametrize("name,width,top", [("q8_0", 32, 127), ("q4_0", 32, 7)])
def test_symmetric_error_is_at_most_half_a_step(table, name, width, top):
    rows, df = table
    got = {r.vec_id: r for r in vectors.quantize(df, name).collect()}
    for vec_id, values in rows:
        v = np.array(values)
        restored = np.array(got[vec_id].restored)
        assert len(restored) == len(v)
        codes = [c for b in got[vec_id].quantized for c in b.codes]
        assert all(-top <= c <= top for c in codes)
        for at in range(0, len(v), width):
            block = v[at:at + width]
            scale = np.abs(block).max() / top
            assert np.abs(block - restored[at:at + width]).max() <= scale / 2 * (1 + 1e-9)


def test_nf4_takes_the_nearest_level(table):
    rows, df = table
    levels = np.array(fv.NF4_LEVELS)
    got = {r.vec_id: r for r in vectors.quantize(df, "nf4").collect()}
    for vec_id, values in rows:
        v = np.array(values)
        restored = np.array(got[vec_id].restored)
        for at in range(0, len(v), 64):
            block = v[at:at + 64]
            scale = np.abs(block).max()
            want = np.zeros(len(block)) if scale == 0 else levels[
                np.abs(block[:, None] / scale - levels[None, :]).argmin(axis=1)] * scale
            assert np.allclose(np.abs(block - restored[at:at + 64]), np.abs(block - want), atol=1e-12)


def test_zero_and_empty_vectors(table):
    _, df = table
    for name in vectors.FORMATS:
        got = {r.vec_id: r.restored for r in vectors.quantize(df, name).where("vec_id in (20, 24)").collect()}
        assert set(got[20]) == {0.0} and got[24] == []


def test_nested_scales_follow_the_stated_grouping(table):
    rows, df = table
    scales = []
    for vec_id, values in rows:
        v = np.array(values)
        scales += [(vec_id, at // 64, np.abs(v[at:at + 64]).max()) for at in range(0, len(v), 64)]
    got = {(r.vec_id, r.block): r for r in vectors.nested_scales(df).collect()}
    assert len(got) == len(scales)
    for start in range(0, len(scales), 256):
        group = scales[start:start + 256]
        mean = np.mean([s for _, _, s in group])
        step = max(abs(s - mean) for _, _, s in group) / 127
        for vec_id, block, s in group:
            r = got[vec_id, block]
            assert r.grp == start // 256 and abs(r["mean"] - mean) < 1e-9
            assert abs(r.restored_scale - s) <= step / 2 + 1e-9 and abs(r.code) <= 127


def test_report_and_budget(table):
    rows, df = table
    n = sum(len(v) for _, v in rows)
    report = vectors.report(df).unionByName(vectors.nested_report(df))
    got = {r["format"]: r for r in report.collect()}
    assert {k: r.bits_per_value for k, r in got.items()} == {
        "q8_0": 8.5, "q4_0": 4.5, "nf4": 4.5, "nf4_nested": 4 + 8.25 / 64}
    assert all(r.n_values == n and r.bytes == -(-n * r.bits_per_value // 8) for r in got.values())
    assert got["q8_0"].rmse < got["nf4"].rmse < got["q4_0"].rmse
    restored = {r.vec_id: r.restored for r in vectors.quantize(df, "q8_0").collect()}
    diffs = np.concatenate([np.array(v) - np.array(restored[i]) for i, v in rows])
    assert abs(got["q8_0"].rmse - np.sqrt((diffs ** 2).mean())) < 1e-7
    pick = lambda bits: vectors.within_budget(report, F.lit(n * bits / 8)).first()["format"]
    assert (pick(16), pick(5), pick(4.2), pick(3)) == ("q8_0", "nf4", "nf4_nested", None)


def test_midpoint_takes_the_lower_level(spark):
    middle = bl.NF4_MIDPOINTS[9]
    df = spark.createDataFrame([(1, [1.0, middle])], "vec_id bigint, embedding array<double>")
    codes = vectors.quantize(df, "nf4").select("quantized.codes").first()[0][0]
    assert list(codes) == [15, 9]


def test_all_formats_from_one_reading(table):
    _, df = table
    line = lambda r: (*r[:4], round(r.rmse, 7), round(r.max_abs_err, 7))
    apart = vectors.report(df).unionByName(vectors.nested_report(df)).collect()
    assert sorted(map(line, vectors.full_report(df).collect())) == sorted(map(line, apart))


def test_nested_report_follows_the_nested_scales(table):
    rows, df = table
    stored = {(r.vec_id, r.block): r.restored_scale for r in vectors.nested_scales(df).collect()}
    levels, lost = np.array(fv.NF4_LEVELS), []
    for vec_id, values in rows:
        v = np.array(values)
        for at in range(0, len(v), 64):
            block = v[at:at + 64]
            scale = np.abs(block).max()
            codes = np.searchsorted(bl.NF4_MIDPOINTS, block / scale) if scale else np.full(len(block), 7)
            lost += (block - levels[codes] * stored[vec_id, at // 64]).tolist()
    got = vectors.nested_report(df).first()
    assert abs(got.rmse - np.sqrt(np.mean(np.square(lost)))) < 1e-7 and abs(got.max_abs_err - np.abs(lost).max()) < 1e-7


def test_reports_have_a_line_for_every_format_without_vectors(table):
    _, df = table
    for lines in (vectors.report(df.limit(0)), vectors.full_report(df.where("vec_id < 0"))):
        assert all(r.n_values is None and r.bytes is None and r.rmse is None for r in lines.collect()) and lines.count() >= 3


@pytest.mark.parametrize("name", sorted(vectors.FORMATS))
def test_packed_bytes_have_the_reported_size_and_come_back(spark, name):
    rows = [(k, rng.normal(size=128).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    fmt = vectors.FORMATS[name]
    size = vectors.pack(df, name).agg(F.sum(F.octet_length("packed"))).first()[0]
    assert size == {r["format"]: r.bytes for r in vectors.report(df).collect()}[name] == 300 * 128 * fmt.bits / 8
    got = {r.vec_id: r.restored for r in vectors.unpack(vectors.pack(df, name), name).collect()}
    exact = {r.vec_id: r.restored for r in vectors.quantize(df, name).collect()}
    for vec_id, values in rows:
        # a scale of 16 bits is off by 2**-11 at most, and so is what it restores, unless a code falls on the other side of a half
        step = np.abs(values).max() / fmt.rule.top
        assert np.abs(np.array(got[vec_id]) - exact[vec_id]).max() <= step * (1 if not fmt.rule.levels else 2**-11) * 1.01
        assert np.abs(np.array(got[vec_id]) - values).max() <= np.abs(np.array(exact[vec_id]) - values).max() + np.abs(values).max() * 2**-10


@pytest.mark.parametrize("name", sorted(vectors.FORMATS))
@pytest.mark.parametrize("bits", [32, 64])
def test_packing_keeps_every_length(spark, name, bits):
    rows = [(n, (rng.normal(size=n) * 3).tolist()) for n in [*range(0, 70), 127, 128, 129, 1_001]] + [(-1, None), (-2, [0.0] * 33)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    packed = vectors.pack(df, name, scale_bits=bits)
    got = {r.vec_id: (r.packed, r.restored) for r in vectors.unpack(packed, name, scale_bits=bits).collect()}
    fmt = vectors.FORMATS[name]
    for n, values in rows:
        packed_bytes, back = got[n]
        if values is None:
            assert packed_bytes is None and back is None
            continue
        sizes = [min(fmt.rule.block, len(values) - at) for at in range(0, len(values), fmt.rule.block)]
        assert len(packed_bytes) == sum(bits // 8 + -(-size * fmt.rule.code_bits // 8) for size in sizes)
        assert len(back) == len(values)
        if values:
            assert np.abs(np.array(back) - values).max() <= np.abs(values).max() * (0.16 if fmt.rule.code_bits == 4 else 0.005)


def test_a_scale_beyond_its_width_is_not_stored(spark):
    df = spark.createDataFrame([(1, [1e9, 1.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in vectors.unpack(vectors.pack(df, "q8_0"), "q8_0").collect()}
    assert got[1].packed is None and got[1].restored is None and len(got[2].restored) == 2
    assert vectors.quantize(df, "q8_0").where("restored is null").count() == 0


def test_rounding_is_away_from_zero_at_halves():
    assert bl.rounded(np.array([0.5, -0.5, 1.5, 0.49999999999999994, -2.5, 2.0])).tolist() == [1, -1, 2, 0, -3, 2]

import random

import pytest
from pyspark.sql import functions as F

from waybill.functions import geometry, temporal, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def check(spark, f, cases, kind="string"):
    assert results(column(spark, [v for v, _ in cases], kind), f(F.col("v"))) == [w for _, w in cases]


def completed(stem):
    """Nine digits and the two check digits that the rule gives them."""
    digits = [int(c) for c in stem]
    for _ in range(2):
        rest = sum(d * w for d, w in zip(digits, range(len(digits) + 1, 1, -1), strict=True)) % 11
        digits.append(0 if rest < 2 else 11 - rest)
    return "".join(map(str, digits))


def test_tax_ids(spark):
    rnd = random.Random(3)
    cases = [("", False), (None, False), ("0", False), ("x" * 11, False)] + [(str(d) * 11, False) for d in range(10)]
    for _ in range(40):
        good = completed(f"{rnd.randrange(10**9):09d}")
        at = rnd.randrange(11)
        changed = good[:at] + str((int(good[at]) + rnd.randrange(1, 10)) % 10) + good[at + 1 :]
        same = changed if changed[:9] != good[:9] else changed[:9]
        right = completed(same[:9]) == changed
        dotted = f"{good[:3]}.{good[3:6]}.{good[6:9]}-{good[9:]}"
        cases += [(good, True), (dotted, True), (f" {dotted} ", True), (changed, right), (good[:10], False), (good + "0", False), (good[:10] + "é", False)]
    check(spark, text.tax_id_ok, cases)


def test_phones(spark):
    codes = sorted(text.STATE_OF_CODE)
    unknown = [f"{i:02d}" for i in range(11, 100) if f"{i:02d}" not in text.STATE_OF_CODE]
    assert len(codes) == 67 and len(unknown) == 22
    numbers, valid = [], []
    for i, code in enumerate(codes):
        fixed, mobile = f"{2 + i % 8}{i:07d}", f"9{i:08d}"
        numbers += [(f"+55 (0{code}) {fixed[:4]}-{fixed[4:]}", code + fixed), (f"0{code} {mobile}", code + mobile), (f"55{code}{mobile}", code + mobile), (f"{code}.{fixed}", code + fixed)]
        valid += [(f"({code}) {fixed}", True), (f"+55 {code} {mobile}", True), (f"{code}1{fixed[1:]}", False), (f"{code}0{fixed[1:]}", False), (f"{code}8{mobile[1:]}", False), (f"{code}{fixed[:7]}", False), (f"{code}{mobile}0", False)]
    check(spark, text.national_phone, [*numbers, ("", ""), (None, None), ("none", "")])
    check(spark, text.phone_ok, [*valid, *((f"{u}22223333", False) for u in unknown), ("", False), (None, False), ("none", False)])
    check(spark, text.area_code, [(f"+55 (0{c}) 2222-3333", c) for c in codes] + [(None, None)])
    check(spark, text.state_of, [*text.STATE_OF_CODE.items(), *((u, None) for u in unknown), (None, None)])


def test_licenses_and_plates(spark):
    check(spark, text.license_ok, [("12345678901", True), ("1234567890", False), ("1234567890a", False), ("", False), (None, False)])
    check(spark, text.license_class_ok, [("C", True), ("D", True), ("E", True), ("A", False), ("c", False), (None, False)])
    check(spark, text.plate_ok, [("ABC1234", True), ("ABC1D23", True), ("ABC12345", False), ("AB12345", False), ("abc1234", False), (None, False)])


def test_lenient_values(spark):
    check(spark, lambda c: text.lenient_timestamp(c).cast("string"), [(" 2024-01-02 ", "2024-01-02 00:00:00"), ("2024-02-30", None), ("x", None), (None, None)])
    check(spark, text.filled, [("a", True), ("", False), (None, False), (" ", True)])
    check(spark, lambda c: text.filled(c), [(1, True), (None, False)], "int")
    check(spark, text.upper_trim, [(" aé ", "AÉ"), (None, None)])


def test_hours(spark):
    df = spark.sql("select timestamp'2024-01-01 10:00:00' a, timestamp'2024-01-01 08:30:00' b, cast(null as timestamp) n")
    row = df.select(temporal.hours_between(F.col("a"), F.col("b")), temporal.hours_between(F.col("a"), F.col("n")), temporal.month_of(F.col("a")), temporal.is_late(F.col("b"), F.col("a"), F.lit("X"), "L"), temporal.is_late(F.col("n"), F.col("a"), F.lit(None).cast("string"), "L"), temporal.is_late(F.col("a"), F.col("b"), F.lit("L"), "L")).first()
    assert tuple(row) == (-1.5, None, "2024-01", True, False, True)


def box(*p):
    a, b, c, d = p
    return '{"type":"Polygon","coordinates":[[[%s,%s],[%s,%s],[%s,%s],[%s,%s],[%s,%s]]]}' % (a, b, c, b, c, d, a, d, a, b)


def test_polygons(spark):
    open_ring = '{"type":"Polygon","coordinates":[[[-50,-20],[-49,-20],[-49,-19],[-50,-19]]]}'
    check(spark, geometry.polygon_ok, [(None, True), (box(-50, -20, -49, -19), True), (open_ring, True), ("junk", False), ('{"type":"Point","coordinates":[1,2]}', False), (box(0, 0, 1, 1), False), ('{"type":"Polygon","coordinates":[]}', False)])
    check(spark, geometry.polygon_in_bounds, [(None, True), (box(-50, -20, -49, -19), True), (box(10, 10, 11, 11), False), ("junk", True), (box(-50, -20, -49, 6), False)])
    check(spark, geometry.closed, [(None, False), (box(-50, -20, -49, -19), True), (open_ring, False), ("junk", False), ('{"type":"Polygon","coordinates":[[[1],[2,3],[4,5],[1]]]}', False)])


@pytest.mark.parametrize("shape, inside", [
    ([[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]], lambda x, y: 0 <= x <= 4 and 0 <= y <= 4 and not (1 < x < 3 and 1 < y < 3)),
    ([[(0, 0), (4, 0), (4, 1), (2, 1), (2, 4), (0, 4), (0, 0)]], lambda x, y: (0 <= x <= 4 and 0 <= y <= 1) or (0 <= x <= 2 and 0 <= y <= 4)),
    ([[(0, 0), (4, 0), (0, 4), (0, 0)]], lambda x, y: x >= 0 and y >= 0 and x + y <= 4),
])
def test_containment_on_a_lattice(spark, shape, inside):
    text_ = '{"type":"Polygon","coordinates":[%s]}' % ",".join("[%s]" % ",".join("[%s,%s]" % p for p in ring) for ring in shape)
    points = [(x / 2, y / 2) for x in range(-2, 11) for y in range(-2, 11)]
    df = spark.createDataFrame(points, "x double, y double").withColumn("lines", geometry.edges(F.lit(text_)))
    got = {(r["x"], r["y"]): r["hit"] for r in df.select("x", "y", geometry.contains(F.col("x"), F.col("y"), F.col("lines")).alias("hit")).collect()}
    assert got == {p: inside(*p) for p in points}

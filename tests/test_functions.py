"""Functions against hand-computed values, published vectors and properties."""

import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelstone.errors import Refused
from keelstone.functions import ais, canonical, geometry, signing, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double'}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("value", "ok"), [("2026-01-02T03:04:05Z", True), ("2026-01-02T03:04:05.123+05:30", True), ("2026-01-02", False), ("2026-01-02T03:04:05", False), ("2026-13-02T03:04:05Z", False), ("2026-01-02T03:04:05Z\n", False)])
def test_instants_need_an_offset(spark, value, ok):
    assert (one(spark, text.instant(F.col("v")), v=value) is not None) == ok


@pytest.mark.parametrize(("value", "ok"), [("abc", True), (" abc", False), ("abc ", False), ("a\x07b", False), ("", False), (None, False), ("ä" * 128, True), ("ä" * 129, False)])
def test_canonical_text(spark, value, ok):
    assert one(spark, text.is_canonical_text(F.col("v"), 256), v=value) == ok


def test_keys_tell_nulls_apart(spark):
    a, b = (one(spark, text.digest_key(F.col("a"), F.col("b")), a="x", b=v) for v in (None, ""))
    assert a != b


def test_periods(spark):
    start, end = spark.range(1).select(*[c.cast("string").alias(n) for n, c in zip("ab", text.period_bounds("2025-12"))]).first()
    assert (start, end) == ("2025-12-01 00:00:00", "2026-01-01 00:00:00")
    with pytest.raises(ValueError):
        text.period_bounds("2025-13")


def test_base64url(spark):
    assert bytes(one(spark, text.base64url_bytes(F.col("v")), v="-_8")) == b"\xfb\xff"
    assert one(spark, text.base64url_bytes(F.col("v")), v="a+b/") is None


#: RFC 8785, section 3.2.2 and appendix B.
@pytest.mark.parametrize(("value", "written"), [(333333333.33333329, "333333333.3333333"), (1e30, "1e+30"), (4.50, "4.5"), (2e-3, "0.002"), (1e-27, "1e-27"), (-0.0, "0"), (5e-324, "5e-324"), (1.7976931348623157e308, "1.7976931348623157e+308"), (9007199254740992.0, "9007199254740992"), (295147905179352830000.0, "295147905179352830000"), (1e21, "1e+21"), (1e23, "1e+23"), (0.000001, "0.000001"), (1e-7, "1e-7"), (100.0, "100"), (10.5, "10.5")])
def test_numbers_as_ecmascript_writes_them(value, written):
    assert canonical.jcs(value) == written


@given(st.floats(allow_nan=False, allow_infinity=False))
@settings(max_examples=300, deadline=None)
def test_written_numbers_read_back(x):
    assert float(canonical.jcs(x)) == x


def test_jcs_sorts_by_utf16_units():
    assert canonical.jcs({"\U0001f600": 1, "דּ": 2, "a": [True, None, "€"]}) == '{"a":[true,null,"€"],"\U0001f600":1,"דּ":2}'
    with pytest.raises(ValueError):
        canonical.jcs({"a": math.nan})
    with pytest.raises(ValueError):
        canonical.strict_loads('{"a": 1, "a": 2}')


def test_canonical_columns(spark):
    assert one(spark, canonical.to_canonical_json(F.col("v")), v='{"b": 2.50, "a": "é"}') == '{"a":"é","b":2.5}'
    assert one(spark, canonical.to_canonical_json(F.col("v")), v="{oops") is None


#: RFC 8032, section 7.1.
VECTORS = [
    ("9d61b19deffd5a60ba844af492ec2cc44449c5697b326919703bac031cae7f60", "d75a980182b10ab7d54bfed3c964073a0ee172f3daa62325af021a68f707511a", "", "e5564300c360ac729086e2cc806e828a84877f1eb8e5d974d873e065224901555fb8821590a33bacc61e39701cf9b46bd25bf5f0595bbe24655141438e7a100b"),
    ("4ccd089b28ff96da9db6c346ec114e0f5b8a319f35aba624da8cf6ed4fb8a6fb", "3d4017c3e843895a92b70aa74d1b7ebc9c982ccf2ec4968cc0cd55f12af4660c", "72", "92a009a9f0d4cab8720e820b5f642540a2b27b5416503f8fb3762223ebdb69da085ac1e43e15996e458f3613d0f11d8c387b2eaeb4302aeeb00d291612bb0c00"),
]


@pytest.mark.parametrize(("seed", "key", "message", "signature"), VECTORS)
def test_ed25519_vectors(seed, key, message, signature):
    seed, key, message, signature = map(bytes.fromhex, (seed, key, message, signature))
    assert signing.public_key(seed) == key and signing.sign(seed, message) == signature
    assert signing.verify(key, message, signature) and not signing.verify(key, message + b"x", signature)
    assert not signing.verify(key, message, signature[:32] + (int.from_bytes(signature[32:], "little") + signing.ORDER).to_bytes(32, "little"))


def test_faults_of_signatures():
    seed = bytes(range(32))
    keys = {"k": signing.public_key(seed)}
    good = signing.signed_envelope({"a": 1, "provenance": {"principalId": "p"}}, seed, "k")
    assert signing.verification_fault(good, keys) == ""
    assert signing.verification_fault(good | {"a": 2}, keys) == signing.PAYLOAD_MISMATCH
    assert signing.verification_fault(good, {}) == signing.UNKNOWN_KEY
    assert signing.verification_fault({"a": 1}, keys) == signing.MALFORMED
    assert signing.verification_fault(signing.signed_envelope({"provenance": {}}, bytes(32), "k"), keys) == signing.BAD_SIGNATURE
    head, body, sig = good["provenance"]["signature"].split(".")
    other = signing.b64url(b'{"alg":"none","kid":"k"}')
    assert signing.verification_fault(good | {"provenance": good["provenance"] | {"signature": f"{other}.{body}.{sig}"}}, keys) == signing.BAD_ALGORITHM


def test_key_directory(tmp_path):
    f = tmp_path / "keys.json"
    f.write_text(json.dumps({"k": signing.b64url(bytes(32))}))
    assert signing.load_key_directory(str(f)) == {"k": bytes(32)}
    f.write_text(json.dumps({"k": signing.b64url(bytes(31))}))
    with pytest.raises(ValueError):
        signing.load_key_directory(str(f))


SENTENCE = "!AIVDM,1,1,,B,177KQJ5000G?tO`K>RA1wUbN0TKH,0*5C"


def test_ais(spark):
    assert one(spark, ais.sentence_valid(F.col("v")), v=SENTENCE) is True
    assert one(spark, ais.sentence_valid(F.col("v")), v=SENTENCE[:-1] + "D") is False
    r = ais.decode([SENTENCE])
    assert (r["message_type"], r["mmsi"], r["speed_knots"]) == (1, "477553000", 0.0)
    assert math.isclose(r["latitude"], 47.58283, abs_tol=1e-4) and math.isclose(r["longitude"], -122.34583, abs_tol=1e-4)
    for bad in ([], ["!AIVDM,2,1,1,B,177,0*00"], [SENTENCE, SENTENCE]):
        with pytest.raises(ValueError):
            ais.decode(bad)
    assert spark.createDataFrame([([SENTENCE],), (["x"],)], "s array<string>").select(ais.decode_reports("s").alias("r")).where("r.fault is null").count() == 1


def test_wkt(spark):
    assert one(spark, geometry.point_wkt(F.lit(-0.00000001), F.lit(2.5))) == "POINT (0 2.5)"
    kind, c = geometry.parse_wkt("POLYGON ((0 0, 1 0, 1 1, 0 0))")
    assert geometry.wkb(kind, c).hex().startswith("010300000001000000040000000000000000000000")
    assert geometry.wkb("POINT", (1.0, 2.0)).hex() == "0101000000000000000000f03f0000000000000040"
    for bad in ("POINT (1)", "LINESTRING (1 1)", "POLYGON ((0 0, 1 0, 1 1, 0 1))", "CIRCLE (0 0)", "POINT (1 2) x"):
        with pytest.raises(ValueError):
            geometry.parse_wkt(bad)


@pytest.mark.parametrize(("x", "y", "inside"), [(5, 5, False), (1, 1, True), (0, 5, True), (10, 10, True), (4, 5, False), (11, 5, False), (25, 25, True)])
def test_point_in_polygons(spark, x, y, inside):
    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    polygons = geometry.validate_geofence({"type": "MultiPolygon", "coordinates": [[square(0, 10), square(4, 6)], [square(20, 30)]]})
    rows = spark.createDataFrame([([[[{"x": p[0], "y": p[1]} for p in r] for r in rings] for rings in polygons], float(x), float(y))], "p array<array<array<struct<x: double, y: double>>>>, x double, y double")
    assert rows.select(geometry.in_polygons(F.col("p"), F.col("x"), F.col("y")).alias("i")).first().i == inside


def test_geofence_rules():
    for bad in ({"type": "Point"}, {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}, {"type": "Polygon", "coordinates": [[[0, 0], [200, 0], [1, 1], [0, 0]]]}):
        with pytest.raises(ValueError):
            geometry.validate_geofence(bad)


@given(st.lists(st.tuples(st.floats(-10, 10), st.floats(-10, 10)), min_size=2, max_size=25), st.floats(0.01, 5))
@settings(max_examples=150, deadline=None)
def test_simplified_lines(points, tolerance):
    made = geometry.simplify_simple(points, tolerance)
    assert made[0] == points[0] and made[-1] == points[-1] and set(made) <= set(points)
    if geometry.is_simple(points):
        assert geometry.is_simple(made)


def test_sweep_agrees_with_all_pairs():
    import random

    rng = random.Random(1)
    for _ in range(300):
        ps = [(rng.randint(0, 8), rng.randint(0, 8)) for _ in range(7)]
        naive = not any(geometry._meet(ps[i], ps[i + 1], ps[j], ps[j + 1]) for i in range(6) for j in range(i + 2, 6))
        assert geometry.is_simple(ps) == naive


def test_refusals_are_value_errors():
    assert issubclass(Refused, ValueError)

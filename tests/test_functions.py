import datetime as dt
import hashlib
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from vaultspark.functions import hashing, scalar
from vaultspark.functions.inet import inet_order, is_inet
from vaultspark.sources.sinks import partition_label


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_hash_key_normalises_and_nulls(spark):
    out = one(spark, hashing.hash_key("k"), [(" ab ",), ("AB",), (None,), ("",), ("   ",)], "k string")
    assert out[0] == out[1] == md5("AB")
    assert out[2:] == [None, None, None]


def test_hash_key_keeps_tab(spark):
    out = one(spark, hashing.hash_key("k"), [("\tab",)], "k string")
    assert out == [md5("\tAB")]


def test_composite_key_and_diff(spark):
    df = spark.createDataFrame([(1, "x"), (None, None), (None, " y ")], "a int, b string")
    rows = df.select(hashing.hash_key("a", "b").alias("k"), hashing.hash_diff("a", "b").alias("d")).collect()
    assert rows[0].k == md5("1||X") and rows[0].d == md5("1||X")
    assert rows[1].k is None and rows[1].d == md5("^^||^^")
    assert rows[2].k == md5("^^||Y")


def test_hash_of_types(spark):
    df = spark.createDataFrame([(dt.date(2013, 1, 5), True, dt.datetime(2020, 1, 1, 0, 0, 0, 120000))],
                               "d date, b boolean, t timestamp_ntz")
    r = df.select(hashing.hash_diff("d"), hashing.hash_diff("b"), hashing.hash_diff("t")).first()
    assert list(r) == [md5("2013-01-05"), md5("TRUE"), md5("2020-01-01 00:00:00.12")]


def test_uuid_text(spark):
    assert one(spark, hashing.uuid_text("h"), [("0123456789abcdef0123456789abcdef",)], "h string") == [
        "01234567-89ab-cdef-0123-456789abcdef"]


def test_float_to_int_rounds_half_even(spark):
    assert one(spark, scalar.float_to_int("x"), [(12.5,), (13.5,), (-2.7,), (None,)], "x double") == [12, 14, -3, None]


def test_truncating_int(spark):
    assert one(spark, scalar.truncating_int("x"), [("12.5",), ("x",), ("-2.7",), ("7",)], "x string") == [12, None, -2, 7]
    assert one(spark, scalar.truncating_int("x"), [(12.5,), (-2.7,)], "x double") == [12, -2]


def test_text_to_int_strict_and_tolerant(spark):
    df = spark.createDataFrame([("12.5",)], "x string")
    with pytest.raises(Exception):
        df.select(scalar.text_to_int("x")).collect()
    assert df.select(scalar.text_to_int("x", strict=False)).first()[0] is None


def test_month_start(spark):
    assert one(spark, scalar.month_start("p"), [("2013-07",)], "p string") == [dt.date(2013, 7, 1)]
    assert one(spark, scalar.month_start("p", strict=False), [("2013-13",)], "p string") == [None]
    assert one(spark, scalar.hive_month_start("p"), [("2013-13",), ("2013-02",)], "p string") == [None, dt.date(2013, 2, 1)]


def test_ipv4(spark):
    data = [("192.168.1.7",), ("1.2.3",), ("300.1.1.1",), ("10.0.0.1",)]
    assert one(spark, scalar.ipv4_to_int("ip"), data, "ip string") == [-1062731513, None, 738263297, 167772161]
    assert one(spark, scalar.ipv4_to_long("ip"), data[:1], "ip string") == [3232235783]
    assert one(spark, scalar.is_ipv4("ip"), data, "ip string") == [True, False, False, True]
    assert one(spark, scalar.inet_text("ip"), [("1.2.3.4",), ("1.2.3.0/24",)], "ip string") == ["1.2.3.4/32", "1.2.3.0/24"]
    assert one(spark, scalar.inet("ip", "null"), data, "ip string") == ["192.168.1.7", None, None, "10.0.0.1"]
    with pytest.raises(Exception):
        spark.createDataFrame(data, "ip string").select(scalar.inet("ip")).collect()


def printed_inet(text):
    """INET's way of printing in plain Python, from the 128 bits."""
    address, _, mask = text.partition("/")
    value = ipaddress.ip_address(address)
    if value.version == 4:
        return address + (f"/{mask}" if mask and mask != "32" else "")
    words = [int(value) >> (112 - 16 * i) & 0xFFFF for i in range(8)]
    best = max(((j - i, -i) for i in range(8) for j in range(i + 1, 9) if not any(words[i:j])), default=(0, 0))
    most, first = best[0], -best[1]
    dotted = ".".join(str(b) for b in int(value).to_bytes(16, "big")[12:])
    if first == 0 and (most == 6 or most == 7 and words[7] != 1 or most == 5 and words[5] == 0xFFFF):
        shown = ("::ffff:" if most == 5 else "::") + dotted
    elif most < 2:
        shown = ":".join(f"{w:x}" for w in words)
    else:
        shown = ":".join(f"{w:x}" for w in words[:first]) + "::" + ":".join(f"{w:x}" for w in words[first + most:])
    return shown + (f"/{mask}" if mask and mask != "128" else "")


def test_inet_of_both_families(spark):
    rnd = random.Random(4)
    good = ["::", "::1", "::2", "::0.0.0.1", "1::", "2001:DB8::1", "2001:db8:0:0:1:0:0:1", "1:0:2:0:3:0:4:0", "fe80::1/64", "::/0", "::ffff:10.0.1.7",
            "::FFFF:0a00:0107", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "0:0:0:0:0:0:0:1/128", "1.2.3.4", "1.2.3.4/32", "1.2.3.0/24",
            "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "0001:0::0"]
    for _ in range(300):
        words = [rnd.choice([0, 0, 0, 1, 0xFFFF, rnd.randrange(65536)]) for _ in range(8)]
        plain = ":".join(f"{w:0{rnd.choice([1, 4])}x}" for w in words)
        good += [plain, str(ipaddress.ip_address(plain)).upper() + rnd.choice(["", "/128", "/0", "/99"])]
    bad = ["", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "12345::", "g::", "::1/129", "::1/", "/64", "1.2.3.4/33",
           "1.2.3", "::1.2.3", "::256.1.1.1", "1.2.3.4::", "1:2:3:4:5:6:7:1.2.3.4", "x", " ::1", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:"]
    data = [(t,) for t in good]
    assert one(spark, scalar.inet("ip", "null"), data, "ip string") == [printed_inet(t) for t in good]
    assert one(spark, scalar.inet("ip"), data, "ip string") == [printed_inet(t) for t in good]
    assert one(spark, scalar.inet("ip", "null"), [(t,) for t in bad], "ip string") == [None] * len(bad)
    assert one(spark, is_inet("ip"), [("::1",), ("1::2::3",), (None,), ("1.1.1.1",)], "ip string") == [True, False, None, True]
    assert one(spark, scalar.inet_text("ip"), [("::1",), ("fe80::/10",)], "ip string") == ["::1/128", "fe80::/10"]
    with pytest.raises(Exception):
        spark.createDataFrame([("1::2::3",)], "ip string").select(scalar.inet("ip")).collect()


def test_inet_order_follows_the_bits(spark):
    good = ["::1", "::2", "2001:db8::1", "2001:DB8:0::0:1", "1.2.3.4", "255.0.0.1", "9.0.0.0/8", "9.0.0.0", "ffff::", "::ffff:1.2.3.4", "::/0"]
    keys = dict(zip(good, one(spark, inet_order("ip"), [(t,) for t in good], "ip string")))
    want = sorted(good, key=lambda t: (lambda a, m: (a.version, int(a), int(m or a.max_prefixlen)))(ipaddress.ip_address(t.split("/")[0]), t.partition("/")[2]))
    assert sorted(good, key=lambda t: (bytes(keys[t]))) == want
    assert keys["2001:db8::1"] == keys["2001:DB8:0::0:1"] and len(keys["::1"]) == 18
    assert one(spark, inet_order("ip"), [("x",), (None,), ("1::2::3",)], "ip string") == [None] * 3


def test_epoch_millis(spark):
    ms = 1388534400123
    out = one(spark, scalar.epoch_millis_to_ts("m"), [(ms,)], "m long")
    assert out == [dt.datetime(2014, 1, 1, 0, 0, 0, 123000)]
    back = spark.createDataFrame([(ms,)], "m long").select(
        scalar.ts_to_epoch_millis(scalar.epoch_millis_to_ts("m"))).first()[0]
    assert back == ms
    assert scalar.epoch_millis_of_year(2014) == 1388534400000


def test_year_slice_pushes_down(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(dt.date(2013, 12, 31),), (dt.date(2014, 1, 1),)], "d date").write.parquet(p)
    df = spark.read.parquet(p).where(scalar.year_slice("d", 2013))
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(d,2013-01-01)" in plan


def test_partition_label(spark):
    data = [(dt.date(1999, 5, 1),), (dt.date(2005, 1, 1),), (dt.date(2031, 1, 1),), (None,),
            (dt.date(2013, 1, 1),), (dt.date(2030, 12, 31),), (dt.date(2012, 12, 31),)]
    assert one(spark, partition_label("d"), data, "d date") == [
        "badyear", "before_2013", "badyear", "badyear", "2013", "2030", "before_2013"]

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flowquarry import config
from flowquarry.functions import identifiers, net


def one(spark, make, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_mac_user_host(spark):
    assert one(spark, identifiers.normal_mac, ["AA-BB-CC-DD-EE-FF", "aa:bb:cc:dd:ee:ff", "aabb.ccdd.eeff", "AA-BB-CC-DD-EE-FF:Net", "AABBCCDDEEFF:5G", "x", "AA-BB", None, ""]) == ["aabbccddeeff"] * 5 + [""] * 4
    assert one(spark, identifiers.normal_user, ["DOM\\Ann", "ann@realm", " ANN ", "a\\b\\Ann@x@y", None]) == ["ann", "ann", "ann", "ann", ""]
    assert one(spark, identifiers.normal_host, ["H.Example.", "h.example..", " h ", "."]) == ["h.example", "h.example.", "h", ""]


def test_tokens(spark, tmp_path):
    import hashlib
    import hmac

    key = tmp_path / "key"
    key.write_text(" secret \n")
    token = identifiers.Identity("hashed", identifiers.read_key(str(key)))
    want = hmac.new(b"secret", b"aabbccddeeff", hashlib.sha256).hexdigest()[:32]
    assert one(spark, token.mac, ["AA-BB-CC-DD-EE-FF", "aabbccddeeff", "nothing"]) == [want, want, ""]
    key.write_text(" \n")
    with pytest.raises(ValueError):
        identifiers.read_key(str(key))
    with pytest.raises(FileNotFoundError):
        identifiers.read_key(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        identifiers.Identity("off")
    plan = spark.range(1).select(token.user(F.lit("x")))._jdf.queryExecution().toString()
    assert "secret" not in plan


def test_private(spark):
    yes = ["10.0.0.1", "172.16.0.1", "172.31.255.255", "192.168.1.1", "127.0.0.1", "169.254.1.1", "::1", "fc00::1", "FD12:3456::5", "fdff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "::ffff:10.0.0.1", "::ffff:c0a8:101"]
    no = ["172.32.0.1", "8.8.8.8", "192.169.0.1", "11.0.0.0", "2001:db8::1", "not an address", "fe80::1", "fe00::1", "::2", "::ffff:8.8.8.8"]
    assert one(spark, net.is_private, yes + no) == [True] * len(yes) + [False] * len(no)


def test_addresses(spark):
    assert one(spark, net.v4_number, ["0.0.0.0", "255.255.255.255", "1.2.3", "1.2.3.256", "01.2.3.4", "", None]) == [0, 2**32 - 1, None, None, None, None, None]
    import ipaddress

    six = ["2001:db8::1", "::", "::1", "1:2:3:4:5:6:7:8", "FE80::A:b", "1::", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33"]
    assert one(spark, net.v6_hex, [*six, "x", "1::2::3", None]) == [f"{int(ipaddress.ip_address(x)):032x}" for x in six] + [None, None, None]
    for length in (0, 1, 7, 32, 45, 64, 127, 128):
        want = [net.network6(f"{x}/{length}")[0] for x in six]
        assert one(spark, lambda c, length=length: net.masked_hex(net.v6_hex(c), length), six) == want
    assert net.network6("10.0.0.0/8") is None and net.network6("2001:db8::1/33") == ("20010db80", 33)
    assert one(spark, net.is_v6, ["2001:db8::1", "::", "1:2:3:4:5:6:7:8", "1.2.3.4", "1::2::3", "x"]) == [True, True, True, False, False, False]
    assert net.cidr("10.1.2.3/16") == (167837696, 167903231, 16) and net.cidr("x/8") is None
    assert one(spark, lambda c: net.endpoint(c)[1], ["10.0.0.1.53", "fd00::1.65535", "10.0.0.1.70000", "none"]) == [53, 65535, None, None]
    assert one(spark, net.port, ["53", "70000", "x", ""]) == [53, 0, 0, 0]


def test_config():
    env = {"A": "5", "B": "x", "D": "1h30m", "T": "true", "Z": "Nowhere/Land"}
    assert config.integer("A", 1, env) == 5 and config.integer("B", 1, env) == 1 and config.text("N", "f", env) == "f"
    assert config.duration("D", timedelta(1), env) == timedelta(minutes=90) and config.duration("B", timedelta(1), env) == timedelta(1)
    assert config.boolean("T", False, env) and config.boolean("B", True, env)
    assert config.log_zone("N", env={}) == "UTC" and config.log_zone("N", env={"LOG_TZ": "Asia/Bangkok"}) == "Asia/Bangkok"
    with pytest.raises(config.ConfigError):
        config.log_zone("Z", env=env)


@pytest.mark.parametrize(("upstream", "key", "logs", "mode"), [(0, 0, 0, "off"), (1, 1, 0, "off"), (1, 0, 1, "passthrough"), (0, 1, 1, "hashed"), (0, 0, 1, "off"), (1, 1, 1, None)])
def test_identity_modes(upstream, key, logs, mode):
    if mode is None:
        with pytest.raises(config.ConfigError):
            config.identity_mode(bool(upstream), bool(key), bool(logs))
    else:
        assert config.identity_mode(bool(upstream), bool(key), bool(logs)) == mode

"""P5/P6 against a brute-force model of the studied consumers' parsing
(Java ``split(",")`` drops trailing empty fields, ``trim`` strips chars
<= U+0020, ``Integer.parseInt`` takes an optional sign and decimal digits
within the int range), on random messages."""

from hypothesis import given, settings
from hypothesis import strategies as st

from gateflow.sources import lines as L

TIME = "2019-01-05 06:10:00"
FIELD = st.text(alphabet=list("0123456789+-. xA,\t"), max_size=6)


def java_split(s: str) -> list[str]:
    parts = s.split(",")
    if len(parts) == 1:
        return parts                      # no separator: the string itself
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def parse_int(s: str):
    body = s[1:] if s[:1] in "+-" else s
    if not body or not body.isascii() or not body.isdigit():
        return None
    v = int(s)
    return v if -2**31 <= v < 2**31 else None


def model_strict(line: str):
    f = java_split(line)
    if len(f) != 7:
        return None
    ints = [parse_int(java_trim(f[i])) for i in (2, 3, 4, 6)]
    if any(v is None for v in ints):
        return None
    return (java_trim(f[1]), ints[0], ints[1], ints[2], java_trim(f[5]), ints[3])


def model_lax(line: str):
    f = java_split(line)
    if len(f) < 7 or len(java_trim(f[0])) < 16:
        return None
    return (java_trim(f[1]), java_trim(f[2]), java_trim(f[4]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(FIELD, min_size=5, max_size=8), min_size=1, max_size=25))
def test_strict_and_lax_match_model(spark, rows):
    msgs = [",".join([TIME, *r]) for r in rows]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    strict = L.parse_strict(df).collect()
    lax = L.parse_lax(df).collect()
    for m, s, x in zip(msgs, strict, lax):
        want = model_strict(m)
        assert s.is_valid == (want is not None), m
        if want is not None:
            assert (s.lineID, s.stationID, s.deviceID, s.status, s.userID, s.payType) == want, m
        want_lax = model_lax(m)
        assert x.is_valid == (want_lax is not None), m
        if want_lax is not None:
            assert (x.lineID, x.stationID, x.status) == want_lax, m

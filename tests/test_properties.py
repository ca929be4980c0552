"""Property test: the ANSI-safe integer cast equals the lenient (non-ANSI) cast semantics."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.casts import lenient_bigint

_EDGE = set(range(0x21)) | {0x7F}


def legacy_long(s):
    """Model of the lenient string → long cast: trim control/space, optional sign, digits,
    an optional well-formed fraction that is truncated; anything else or overflow → None."""
    if s is None:
        return None
    b = s.encode()
    i, j = 0, len(b) - 1
    while i <= j and b[i] in _EDGE:
        i += 1
    if i > j:
        return None
    while j > i and b[j] in _EDGE:
        j -= 1
    neg = b[i] == ord("-")
    if neg or b[i] == ord("+"):
        if j == i:
            return None
        i += 1
    val = 0
    while i <= j:
        c = b[i]
        i += 1
        if c == ord("."):
            break
        if not 48 <= c <= 57:
            return None
        val = val * 10 + (c - 48)
    while i <= j:
        if not 48 <= b[i] <= 57:
            return None
        i += 1
    val = -val if neg else val
    return val if -(2 ** 63) <= val < 2 ** 63 else None


texts = st.one_of(
    st.none(),
    st.text(alphabet="0123456789+-. \t\n\x00\x7fe\x85\u2028", max_size=8),
    st.from_regex(r"\A\s?[+-]?[0-9]{0,20}(\.[0-9]{0,3})?\s?\Z", fullmatch=True),
)


@settings(max_examples=40, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_lenient_bigint_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(lenient_bigint(F.col("s"))).collect()]
    assert got == [legacy_long(v) for v in values]

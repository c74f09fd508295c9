"""Property test: Spark's decode equals a small Python model of the contract."""

import json
import random

from hypothesis import given
from hypothesis import strategies as st

from playtally.functions import decode as dec

INT32 = (-2**31, 2**31 - 1)
INT64 = (-2**63, 2**63 - 1)
BLANKS = "".join(chr(c) for c in range(0x21))


def _as_int(v, bounds):
    if isinstance(v, bool) or v is None:
        return None
    if isinstance(v, str):
        v = v.strip(" ")
        if not v or not (v.isdigit() or (v[0] in "+-" and v[1:].isdigit())):
            return None
        v = int(v)
        return v if bounds[0] <= v <= bounds[1] else None
    if isinstance(v, float):
        v = int(v)
    if isinstance(v, int):  # an unquoted number keeps its low bits
        return (v - bounds[0]) % (bounds[1] - bounds[0] + 1) + bounds[0]
    return None


def model(line, strip):
    """Expected (target_id, count) or None for rejected."""
    if line is None:
        return None
    if strip:
        if line.startswith("message: "):
            line = line[len("message: "):]
        line = line.strip(BLANKS)
    # The parser skips JSON whitespace, reads the first value and ignores any
    # text after it (SURVEY §2.9 "trailing text"); a later duplicate key wins.
    try:
        obj, _ = json.JSONDecoder(object_pairs_hook=dict).raw_decode(line.lstrip(" \t\r\n"))
    except ValueError:
        return None
    if not isinstance(obj, dict):
        return None
    t, c = _as_int(obj.get("targetId"), INT64), _as_int(obj.get("count"), INT32)
    return None if t is None or c is None else (t, c)


_value = st.one_of(
    st.integers(-2**40, 2**40), st.integers(-2**70, 2**70), st.integers(-9999, 9999).map(lambda i: i / 4),
    st.integers(-999, 999).map(str), st.integers(0, 999).map(lambda i: f" {i} "),
    st.just(None), st.booleans(), st.lists(st.integers(0, 9), max_size=2), st.just("x1"))


@st.composite
def message(draw):
    fields = []
    if draw(st.booleans()):
        fields.append(("targetId", draw(_value)))
    if draw(st.booleans()):
        fields.append(("count", draw(_value)))
    for _ in range(draw(st.integers(0, 2))):
        fields.append((draw(st.sampled_from(["extra", "targetId", "count", "other"])), draw(_value)))
    random.Random(draw(st.integers(0, 99))).shuffle(fields)
    body = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in fields) + "}"
    if draw(st.integers(0, 9)) == 0:
        body = draw(st.sampled_from(["[1,2]", "not json", "", "7", '"s"']))
    pad = st.text(alphabet=st.sampled_from([" ", "\t", "\r", "\n", "\x00", "\x0b"]), max_size=3)
    line = draw(pad) + body + draw(pad)
    if draw(st.booleans()):
        line = "message: " + line
    return line


@given(st.lists(message(), min_size=1, max_size=25), st.booleans())
def test_decode_matches_model(spark, lines, strip):
    df = spark.createDataFrame(list(enumerate(lines)), "event_id BIGINT, line STRING")
    got = {r.event_id: (r.target_id, r["count"]) if r.target_id is not None and r["count"] is not None else None
           for r in dec.decode_messages(df, strip=strip).collect()}
    for i, line in enumerate(lines):
        assert got[i] == model(line, strip), f"line={line!r} strip={strip}"

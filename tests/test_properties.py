"""Property tests against small brute-force models (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType, TimestampType

from quarry.operators.dedup import keep_latest
from quarry.operators.flatten import flatten_all, flatten_struct, is_flat
from quarry.operators.upsert import upsert_guarded, upsert_replace

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
LETTERS = "abcdefgh"


@st.composite
def struct_schema(draw, depth=0):
    n = draw(st.integers(1, 3))
    names = draw(st.lists(st.sampled_from(LETTERS), min_size=n, max_size=n, unique=True))
    fields = []
    for name in names:
        if depth < 2 and draw(st.booleans()):
            fields.append(StructField(name, draw(struct_schema(depth + 1)), True))
        else:
            fields.append(StructField(name, IntegerType(), True))
    return StructType(fields)


def _value(dtype, draw, top=False):
    if isinstance(dtype, StructType):
        if not top and draw(st.integers(0, 5)) == 0:
            return None
        return tuple(_value(f.dataType, draw) for f in dtype.fields)
    return draw(st.one_of(st.none(), st.integers(-5, 5)))


def _leaves(dtype, value, prefix, out):
    for i, f in enumerate(dtype.fields):
        v = None if value is None else value[i]
        name = f"{prefix}_{f.name}" if prefix else f.name
        if isinstance(f.dataType, StructType):
            _leaves(f.dataType, v, name, out)
        else:
            out[name] = v
    return out


@SETTINGS
@given(data=st.data())
def test_flatten_struct_keeps_every_leaf(spark, data):
    schema = data.draw(struct_schema())
    rows = [_value(schema, data.draw, top=True) for _ in range(data.draw(st.integers(1, 4)))]
    df = spark.createDataFrame(rows, schema)
    out = flatten_struct(df)
    assert is_flat(out)
    assert len(set(out.columns)) == len(out.columns)
    expected = sorted((tuple(sorted(_leaves(schema, r, "", {}).items())) for r in rows), key=repr)
    got = sorted((tuple(sorted(r.asDict().items())) for r in out.collect()), key=repr)
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 9),
                               st.one_of(st.none(), st.lists(st.integers(0, 3), max_size=3)),
                               st.one_of(st.none(), st.lists(st.integers(0, 3), max_size=2))),
                     min_size=1, max_size=5))
def test_flatten_all_row_count_is_outer_cross_product(spark, rows):
    schema = StructType([StructField("id", IntegerType()), StructField("xs", ArrayType(IntegerType())),
                         StructField("ys", ArrayType(IntegerType()))])
    out = flatten_all(spark.createDataFrame(rows, schema))
    expected = sum(max(1, len(xs or [])) * max(1, len(ys or [])) for _, xs, ys in rows)
    assert out.count() == expected
    assert is_flat(out)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 20))),
                     min_size=1, max_size=25))
def test_dedup_one_row_per_key_with_max(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int")
    out = keep_latest(df, ["k"], ["v"])
    got = {r.k: r.v for r in out.collect()}
    assert len(got) == out.count() == len({k for k, _ in rows})
    for k in got:
        vals = [v for kk, v in rows if kk == k]
        non_null = [v for v in vals if v is not None]
        assert got[k] == (max(non_null) if non_null else None)  # nulls last under desc
    again = keep_latest(out, ["k"], ["v"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, out.collect()), key=str)


DATES = st.one_of(st.none(), st.integers(0, 3).map(lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)))
ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 99), DATES), max_size=8)
UPSERT_SCHEMA = StructType([StructField("id", LongType()), StructField("v", LongType()),
                            StructField("dt_updated", TimestampType())])


def _model_replace(target, stage):
    keys = {s[0] for s in stage if s[0] is not None}
    return [t for t in target if t[0] is None or t[0] not in keys] + list(stage)


def _model_guarded(target, stage, keep_latest_=False):
    def newer_or_equal(s, t):
        return s[2] is not None and t[2] is not None and s[2] >= t[2]

    survivors = [t for t in target
                 if not any(s[0] is not None and s[0] == t[0] and newer_or_equal(s, t) for s in stage)]
    incoming = list(stage)
    if keep_latest_:
        def stale(s):
            return any(t[0] is not None and t[0] == s[0] and t[2] is not None and (s[2] is None or t[2] > s[2])
                       for t in target)
        incoming = [s for s in stage if not stale(s)]
    return survivors + incoming


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@SETTINGS
@given(target=ROWS, stage=ROWS)
def test_upserts_match_brute_force(spark, target, stage):
    t = spark.createDataFrame(target, UPSERT_SCHEMA)
    s = spark.createDataFrame(stage, UPSERT_SCHEMA)
    assert _rows(upsert_replace(t, s, "id")) == _sorted(_model_replace(target, stage))
    assert _rows(upsert_guarded(t, s, "id", "dt_updated")) == _sorted(_model_guarded(target, stage))
    assert _rows(upsert_guarded(t, s, "id", "dt_updated", keep_latest=True)) == \
        _sorted(_model_guarded(target, stage, keep_latest_=True))

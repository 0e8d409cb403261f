"""Merge laws against a plain-Python model, on generated tables."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from pricelake.operators import merge

KEYS = st.sampled_from(["a", "b", "c", "d", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 9), st.integers(0, 9)), max_size=6)
SCHEMA = "k string, x int, y int"


def _unique(rows):
    seen, out = set(), []
    for r in rows:
        if r[0] is None or r[0] not in seen:
            out.append(r)
            if r[0] is not None:
                seen.add(r[0])
    return out


def _model_upsert(t, s, preserve_y=False):
    s_keys = {r[0] for r in s if r[0] is not None}
    t_by = {r[0]: r for r in t if r[0] is not None}
    out = [r for r in t if r[0] is None or r[0] not in s_keys]
    for r in s:
        if preserve_y and r[0] in t_by:
            out.append((r[0], r[1], t_by[r[0]][2]))
        else:
            out.append(r)
    return sorted(out, key=repr)


_cfg = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@_cfg
@given(ROWS, ROWS)
def test_upsert_matches_model(spark, t, s):
    t, s = _unique(t), _unique(s)
    T, S = spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)
    got = sorted((tuple(r) for r in merge.upsert(T, S, ["k"]).collect()), key=repr)
    assert got == _model_upsert(t, s)
    got_p = sorted((tuple(r) for r in merge.upsert(T, S, ["k"], update_cols=["x"]).collect()), key=repr)
    assert got_p == _model_upsert(t, s, preserve_y=True)


@_cfg
@given(ROWS, ROWS)
def test_insert_ignore_and_update_from_match_model(spark, t, s):
    t, s = _unique(t), _unique(s)
    T, S = spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)
    t_keys = {r[0] for r in t if r[0] is not None}
    want_ii = sorted(t + [r for r in s if r[0] is None or r[0] not in t_keys], key=repr)
    assert sorted((tuple(r) for r in merge.insert_ignore(T, S, ["k"]).collect()), key=repr) == want_ii
    s_by = {r[0]: r for r in s if r[0] is not None}
    want_uf = sorted(((r[0], s_by[r[0]][1], r[2]) if r[0] in s_by else r for r in t), key=repr)
    assert sorted((tuple(r) for r in merge.update_from(T, S, ["k"], ["x"]).collect()), key=repr) == want_uf

"""Rules of the reference stated as tests."""

import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.functions.coerce import as_str, to_float, to_int
from corpusprep.functions.records import as_map, insert_before, write_record
from corpusprep.operators import filtering, sampling
from corpusprep.sources.jsonl import VAR, parse_lines


def _parsed(spark, records):
    return parse_lines(spark.createDataFrame([(json.dumps(r),) for r in records], "value string"))


def _ids(df):
    return sorted(r[0] for r in df.select(as_str(F.col(VAR), "id")).collect())


def test_nan_quality_is_kept_and_unparseable_is_dropped(spark):
    recs = [{"id": "a", "ocrqa": "nan"}, {"id": "b", "ocrqa": 0.1}, {"id": "c", "ocrqa": "x"},
            {"id": "d", "ocrqa": 0.9}, {"id": "e"}]
    assert _ids(filtering.filter_records(_parsed(spark, recs), min_quality=0.5)) == ["a", "d"]


def test_type_filter_is_strict_and_untrimmed(spark):
    recs = [{"id": "a", "tp": "1"}, {"id": "b", "tp": 1}, {"id": "c", "tp": " 1 "}]
    assert _ids(filtering.filter_records(_parsed(spark, recs), tp="1")) == ["a"]


def test_normalised_type_match_and_empty_field(spark):
    recs = [{"id": "a", "tp": " article "}, {"id": "b", "tp": "page"}, {"id": "c", "tp": "Article"}]
    df = _parsed(spark, recs)
    v = F.col(VAR)
    assert _ids(df.filter(filtering.type_matches(v, "tp", "article  "))) == ["a"]
    assert _ids(df.filter(filtering.type_matches(v, "", "article"))) == ["a", "b", "c"]


def test_label_compare_is_case_and_space_insensitive(spark):
    recs = [{"id": "a", "ad_class": " Non-Ad "}, {"id": "b", "ad_class": "ad"}, {"id": "c"}]
    df = _parsed(spark, recs)
    assert _ids(df.filter(filtering.is_label(F.col(VAR), "ad_class", "non-ad"))) == ["a"]


def test_language_whitelist_cleaning():
    assert sampling.clean_languages([" de", "de", "", "  ", "fr "]) == ["de", "fr"]
    assert sampling.clean_languages(None) is None


def test_keywords_replace_an_existing_value(spark):
    line = '{"id":"a","keywords":["old"],"lg":"de","ft":"x"}'
    df = spark.createDataFrame([(line,)], "value string")
    kw = F.to_variant_object(F.array(F.lit("new")))
    out = df.select(write_record(insert_before(as_map(F.col("value")), "keywords", kw, "ft"))).first()[0]
    assert out == '{"id":"a","lg":"de","keywords":["new"],"ft":"x"}'


def _py_int(x):
    try:
        return int(x)
    except (TypeError, ValueError, OverflowError):
        return None


def _py_float(x):
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


ascii_numeric = st.from_regex(r"\A[ \t]{0,2}[+-]?[0-9]{1,6}(\.[0-9]{0,3})?([eE][+-]?[0-9]{1,2})?[ \t]{0,2}\Z")
values = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(min_value=-(10**15), max_value=10**15),
    st.floats(min_value=-1e12, max_value=1e12, allow_nan=False),
    ascii_numeric,
    st.text(alphabet="abc xyz\t", max_size=6),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(values, min_size=40, max_size=40))
def test_coercions_agree_with_python(spark, batch):
    lines = [(json.dumps({"id": f"v{i}", "x": v}),) for i, v in enumerate(batch)]
    df = parse_lines(spark.createDataFrame(lines, "value string"))
    v = F.col(VAR)
    got = {r.id: r for r in df.select(as_str(v, "id").alias("id"), to_int(v, "x").alias("i"),
                                      to_float(v, "x").alias("f"), as_str(v, "x").alias("s")).collect()}
    for i, val in enumerate(batch):
        r = got[f"v{i}"]
        assert r.i == _py_int(val), (val, r.i)
        pf = _py_float(val)
        assert (r.f is None) == (pf is None), (val, r.f)
        if pf is not None:
            assert math.isclose(r.f, pf, rel_tol=1e-12), (val, r.f)
        if val is None or isinstance(val, (str, bool, int)):
            assert r.s == ("" if val is None else str(val).strip()), (val, r.s)


def test_append_field_equals_map_route(spark):
    from corpusprep.functions.records import append_field, set_field

    lines = ['{"id":"a","ft":"x"}', '{}', '{ }', '{"id":"b","n":{"k":[1,2]},"z":null}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    lab = F.lit("non-ad")
    rows = df.select(
        append_field(F.col("value"), "ad_class", lab).alias("a"),
        write_record(set_field(as_map(F.col("value")), "ad_class", lab.cast("variant"))).alias("b"),
    ).collect()
    for r in rows:
        assert json.loads(r.a) == json.loads(r.b)
        assert list(json.loads(r.a))[-1] == "ad_class"


json_leaf = st.one_of(st.none(), st.booleans(), st.integers(-10**12, 10**12),
                      st.floats(allow_nan=False, allow_infinity=False, width=32), st.text(max_size=8))
json_obj = st.dictionaries(st.text(max_size=5), st.recursive(json_leaf, lambda c: st.lists(c, max_size=3)
                                                             | st.dictionaries(st.text(max_size=3), c, max_size=3),
                                                             max_leaves=6), max_size=4)


def _mutate(draw_line, kind):
    line = draw_line
    if kind == 1:
        return line[: max(1, len(line) // 2)]
    if kind == 2:
        return line + " x"
    if kind == 3:
        return line + "," + line
    if kind == 4:
        return "[" + line + "]"
    if kind == 5:
        return line.replace('"', "'")
    if kind == 6:
        return " \t" + line + "  "
    if kind == 7:
        return "42"
    return line


def _python_accepts(line):
    try:
        return isinstance(json.loads(line.strip()), dict)
    except ValueError:
        return False


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(json_obj, st.integers(0, 8)), min_size=60, max_size=60))
def test_strict_json_lines_match_python(spark, items):
    lines = [_mutate(json.dumps(obj, ensure_ascii=False), kind) for obj, kind in items]
    lines = [x for x in lines if x.strip()]
    df = parse_lines(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string"))
    got = {r.i: r._status == "ok" for r in df.select("i", "_status").collect()}
    for i, x in enumerate(lines):
        assert got[i] == _python_accepts(x), x

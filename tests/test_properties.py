"""Operators against brute-force Python versions of the same rules, on random inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import one, rows
from tessera.functions import measures as M
from tessera.operators.lists import distinct_list, ordered_list

TEXT = st.one_of(st.none(), st.sampled_from(["", "1", "10", "2", "a", "B", " b"]))


def _key(x):
    """Spark's ascending order with nulls first."""
    return (x is not None, x or "")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2"]), TEXT, TEXT), min_size=1, max_size=40),
       st.booleans())
def test_ordered_list_matches_sorting(spark, data, distinct):
    df = spark.createDataFrame(data, "g string, k string, v string")
    got = dict(rows(ordered_list(df, ["g"], ["k"], "v", "out", distinct=distinct), "g", "out"))
    want = {}
    for g in {r[0] for r in data}:
        entries = [(k, v) for gg, k, v in data if gg == g]
        entries.sort(key=lambda e: (_key(e[0]), _key(e[1])))
        values = [v for _, v in entries if v is not None]
        want[g] = ", ".join(dict.fromkeys(values) if distinct else values)  # of equal values the first stays
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]), TEXT), min_size=1, max_size=40))
def test_distinct_list_matches_sorting(spark, data):
    df = spark.createDataFrame(data, "g string, v string")
    got = dict(rows(distinct_list(df, ["g"], "v", "out"), "g", "out"))
    want = {g: ", ".join(sorted({v for gg, v in data if gg == g and v is not None}))
            for g in {r[0] for r in data}}
    assert got == want


def band_rule(cat, days):
    """The band chain as plain Python: first matching (category, range) wins."""
    if cat is None or days is None:
        return None
    for code, bands in M.ARREARS_BANDS:
        if cat != code:
            continue
        for low, high, label in bands:
            if (high is None and days > low) or (high is not None and low <= days <= high):
                return label
    return None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["0", "1", "2", "3", "4"])),
                          st.one_of(st.none(), st.integers(-5, 700))), min_size=1, max_size=50))
def test_arrears_band_matches_rule(spark, data):
    df = spark.createDataFrame(data, "c string, d int")
    assert one(df.select(M.arrears_band("c", "d").alias("b")), "b") == [band_rule(c, d) for c, d in data]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 100)), min_size=1, max_size=50))
def test_product_line_matches_table(spark, codes):
    table = {}
    for cs, label in M.PRODUCT_LINES:
        for c in cs:
            table.setdefault(c, label)
    df = spark.createDataFrame([(c,) for c in codes], "p int")
    assert one(df.select(M.product_line("p").alias("l")), "l") == [table.get(c, M.PRODUCT_LINE_DEFAULT)
                                                                   for c in codes]


import datetime as dt  # noqa: E402
import re  # noqa: E402

from tessera.functions import text as T  # noqa: E402
from tessera.functions import times as TM  # noqa: E402

DATES = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2099, 12, 31))


def shapes(d):
    """The date texts the consent sources hold, rendered in Python."""
    h12 = d.hour % 12 or 12
    ampm = "AM" if d.hour < 12 else "PM"
    return {
        "iso": d.strftime("%Y-%m-%d %H:%M:%S"),
        "iso_ms": d.strftime("%Y-%m-%d %H:%M:%S.") + f"{d.microsecond // 1000:03d}",
        "dmy": d.strftime("%d/%m/%y ") + f"{h12:02d}" + d.strftime(":%M:%S ") + ampm,
        "dmy_ns": d.strftime("%d/%m/%y ") + f"{h12:02d}" + d.strftime(":%M:%S,") + f"{d.microsecond:06d}000 " + ampm,
    }


@settings(max_examples=15, deadline=None)
@given(st.lists(DATES, min_size=1, max_size=20))
def test_parse_any_matches_python(spark, dates):
    data = []
    for d in dates:
        for shape, text in shapes(d).items():
            sec = d.replace(microsecond=0)
            want_a = {"iso": sec, "iso_ms": d.replace(microsecond=d.microsecond // 1000 * 1000), "dmy": sec,
                      "dmy_ns": None}[shape]
            want_day_first = {"iso": sec, "iso_ms": d.replace(microsecond=d.microsecond // 1000 * 1000),
                              "dmy": sec, "dmy_ns": d}[shape]
            data.append((text, want_a, want_day_first))
    df = spark.createDataFrame([(t,) for t, _, _ in data], "v string")
    got = [tuple(r) for r in df.select(TM.parse_any("v", TM.LAW_A_FORMATS),
                                       TM.parse_any("v", TM.DAY_FIRST_FORMATS)).collect()]
    assert got == [(a, b) for _, a, b in data]


ASCII_TEXT = st.text(alphabet=st.sampled_from(list("aB0 \t\n.xZ9")), max_size=15)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), ASCII_TEXT), st.one_of(st.none(), ASCII_TEXT),
                          st.one_of(st.none(), ASCII_TEXT)), min_size=1, max_size=20))
def test_full_name_and_doc_key_match_python(spark, data):
    def name(a, b, c):
        s = re.sub(r"\s+", " ", " ".join(x or "" for x in (a, b, c))).strip(" ")
        return s[:1].upper() + s[1:].lower()

    def doc(a):
        if a is None:
            return None
        return re.sub(r"\s+", "", a).lstrip("0") or None

    df = spark.createDataFrame(data, "a string, b string, c string")
    got = [tuple(r) for r in df.select(T.full_name("a", "b", "c"), T.doc_key("a")).collect()]
    assert got == [(name(a, b, c), doc(a)) for a, b, c in data]

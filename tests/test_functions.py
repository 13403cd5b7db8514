from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylake.functions import text as t
from quarrylake.functions import values as v
from quarrylake.functions import vocabulary as voc


def apply(spark, f, *inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.select(f(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


HTML = [
    ("<p>One <b>two</b></p>", "One two"),
    ("<li>a</li><li>b</li>", "a b"),
    ("a&nbsp;b", "a b"),
    ("&lt;5 &gt; 3 &quot;x&quot; &#39;y&#39; &#43;1", "<5 > 3 \"x\" 'y' +1"),
    ("&amp;nbsp;", "&nbsp;"),
    ("  many \n\t spaces  ", "many spaces"),
    ("line\nbreak", "line break"),
    ("it&rsquo;s &mdash; &ldquo;fine&rdquo; &bull; ok", "it's — \"fine\" • ok"),
    ("informa&ccedil;&atilde;o &Ccedil;&Otilde;", "informação ÇÕ"),
    ("a&zwj;b", "ab"),
    (None, None),
    ("<br>", ""),
]


def test_html_to_text(spark):
    assert apply(spark, t.html_to_text, *[h for h, _ in HTML]) == [x for _, x in HTML]


def test_escaped_html_is_decoded_twice(spark):
    assert apply(spark, lambda c: t.html_to_text(t.html_to_text(c)), "&lt;p&gt;a&amp;amp;b&lt;/p&gt;") == ["a&b"]


def test_trim_takes_all_unicode_space(spark):
    assert apply(spark, t.trim_all, " \t x y \n", "", None) == ["x y", "", None]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n<>&; ", max_size=20), min_size=1, max_size=6))
def test_html_to_text_is_collapsed(spark, texts):
    for got in apply(spark, t.html_to_text, *texts):
        assert "  " not in got and got == got.strip()


def test_titles(spark):
    assert apply(spark, t.titled, "o'neil-3d_labs", "acme", "x1y") == ["O'Neil 3D Labs", "Acme", "X1Y"]
    for word in ("o'neil-3d_labs", "it's-4ever"):
        assert apply(spark, t.titled, word) == [word.replace("-", " ").replace("_", " ").title()]


def test_percent_decoding_keeps_plus(spark):
    assert apply(spark, t.percent_decoded, "it%20labs", "a+b", "bad%zz") == ["it labs", "a+b", None]


def test_pay_label(spark):
    rows = [("1234.5", "2500", "EUR", "year"), (None, "10", None, None), (None, None, "EUR", "year")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string").select(F.col("a").cast("decimal(38,9)"), F.col("b").cast("decimal(38,9)"), "c", "d")
    got = [r[0] for r in df.select(t.pay_label(*map(F.col, "abcd"))).collect()]
    assert got == ["1,235 - 2,500 EUR / year", "? - 10  / ?", None]


def test_join_sections_skips_nothing(spark):
    df = spark.createDataFrame([("a", "", None, "b"), (None, "", None, "")], "a string, b string, c string, d string")
    assert [r[0] for r in df.select(t.join_sections(*map(F.col, "abcd"))).collect()] == ["a\n\nb", None]


def test_last_piece(spark):
    place = lambda c: t.last_piece(c, r"[\t\n\f\r ]+-[\t\n\f\r ]+|;|•")
    assert apply(spark, place, "Remote - US", "Seoul, South Korea", "Berlin • Germany", "London", None) == ["US", "South Korea", "Germany", "London", None]


def test_employment_from_text(spark):
    words = ["Contractor Full-Time", "Intern / Part-Time", "Sales", "FT", "International Permanent", None, "ft\n"]
    assert apply(spark, voc.employment_from_text, *words) == ["contract", "internship", None, "full_time", "internship", None, None]


def test_times(spark):
    assert apply(spark, v.from_epoch_ms, 1600000000000, 0, None, kind="bigint") == [datetime(2020, 9, 13, 12, 26, 40), datetime(1970, 1, 1), None]
    mails = ["Wed, 30 Sep 2026 09:36:12 +0200", "Thu, 01 Jan 2026 00:00:00 GMT", "soon", None]
    assert apply(spark, v.from_rfc822, *mails) == [datetime(2026, 9, 30, 7, 36, 12), datetime(2026, 1, 1), None, None]
    assert apply(spark, v.from_iso, "2026-09-25 10:47:06 UTC", "2026-09-25T10:47:06+02:00", "x") == [datetime(2026, 9, 25, 10, 47, 6), datetime(2026, 9, 25, 8, 47, 6), None]


def test_dates_are_checked():
    assert v.checked_date("2026-10-06") == "2026-10-06"
    for bad in (None, "23/09/2026", "20260923", "2026-W39-3", "2026-02-30"):
        with pytest.raises(ValueError):
            v.checked_date(bad)


def test_json_scalars_only(spark):
    doc = '{"a": 1, "b": {"c": "x"}, "d": [1], "e": null, "f": "{not an object}"}'
    for path, want in (("$.a", "1"), ("$.b", None), ("$.b.c", "x"), ("$.d", None), ("$.e", None), ("$.z", None), ("$.f", "{not an object}")):
        assert apply(spark, lambda c, p=path: v.json_scalar(c, p), doc, None) == [want, None]


def test_json_arrays_keep_odd_elements(spark):
    assert apply(spark, lambda c: v.json_array(c, "$.l"), '{"l":[{"a":1},"x",3]}', '{"l":5}', "{}") == [['{"a":1}', "x", "3"], None, None]


def test_maps_and_arrays(spark):
    pref = lambda c: v.preferred_key(c, "en", "pt")
    maps = [{"pt": "a", "en": "b"}, {"pt": "a", "de": "b"}, {"fr": "a", "de": "b"}, {}, None]
    assert apply(spark, pref, *maps, kind="map<string,string>") == ["en", "pt", "de", None, None]
    one = lambda c: v.only_match(c, lambda x: x > 2)
    assert apply(spark, one, [1, 3], [3, 4], [], None, kind="array<int>") == [3, None, None, None]
    first = lambda c: v.match_else_first(c, lambda x: x > 2)
    assert apply(spark, first, [1, 3], [1, 2], [], None, kind="array<int>") == [3, 1, None, None]
    assert apply(spark, v.last_of, [1, 3], [], None, kind="array<int>") == [3, None, None]


def test_required_stops_the_job(spark):
    with pytest.raises(Exception, match="missing"):
        apply(spark, lambda c: v.required(c, "id"), "a", None)


def test_flags(spark):
    df = spark.createDataFrame([(True, True, None), (None, True, True), (None, None, True), (None, False, None)], "a boolean, b boolean, c boolean")
    got = df.select(voc.workplace_from_flags(*map(F.col, "abc")), voc.flags_joined("-", remote=F.col("a"), hybrid=F.col("b"), on_site=F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("remote", "remote-hybrid"), ("hybrid", "hybrid-on_site"), ("in_person", "on_site"), ("unknown", None)]


def test_entities_in_one_pass_equal_one_replacement_after_the_other(spark):
    from functools import reduce
    from random import Random

    from quarrylake.functions.text import ENTITIES, decoded

    r = Random(5)
    pieces = ["&", "amp;", "lt;", "&lt;", "&amp;", "zwj;", "&zwj;", "nbsp;", "&nb", "sp;", "&eacute;", "x", ";", "#39;", "&#39;", " ", "l", "t;", "&&", "&rsquo;", "&aacute", "é"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(14))) for _ in range(3000)] + ["", None]
    df = spark.createDataFrame([(x,) for x in texts], "c string")
    got = [row.x for row in df.select(decoded(F.col("c")).alias("x")).collect()]
    chain = lambda t: t if t is None else reduce(lambda s, pair: s.replace(*pair), [*ENTITIES, ("&amp;", "&")], t)
    assert got == [chain(t) for t in texts]

"""The feed's tokens against an XML parser."""

import xml.etree.ElementTree as ET
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarrylake.sources.parsers import PARSERS

NS = "urn:x"


def parsed(spark, *feeds):
    rows = [(f"teamtailor/2026-10-06/c{k}/x.xml", f"c{k}", datetime(2026, 10, 6), f) for k, f in enumerate(feeds)]
    return PARSERS["teamtailor"](spark.createDataFrame(rows, "path string, company_slug string, landed_at timestamp, content string"))


def plain(feed, slug):
    out = []
    for item in ET.fromstring(feed).findall("channel/item"):
        places = item.findall(f"{{{NS}}}locations/{{{NS}}}location")
        here = next((p for p in places if p.findtext(f"{{{NS}}}country") in ("Brazil", "Brasil")), places[0] if places else None)
        city = here.findtext(f"{{{NS}}}city") if here is not None else None
        out.append((slug, item.findtext("guid"), item.findtext("title") or None, item.findtext("description") or None, city or None))
    return out


def got(df):
    return sorted(((r.company_slug, r.id, r.title, r.content, r.city) for r in df.collect()), key=repr)


evil = st.lists(st.sampled_from(["</item>", "<item>", "</channel>", "<b a='>'>", " x ", "&", "]]", "é", "<!--", "-->", '"', "'", "<item><guid>no</guid></item>", "<![CDATA["]), max_size=4).map("".join)
cdata = evil.map(lambda t: "<![CDATA[" + t.replace("]]>", "") + "]]>")
escaped = evil.map(lambda t: t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
comment = evil.map(lambda t: "<!-- " + t.replace("--", "") + " -->")
words = st.sampled_from(["", "Dev", "Über <![CDATA[]]>", "a &amp; b"])
body = st.one_of(cdata, escaped, words)


@st.composite
def item(draw):
    guid = "<guid isPermaLink=" + draw(st.sampled_from(['"fa>lse"', "'x'"])) + f">g{draw(st.integers(0, 9))}</guid>"
    parts = [guid, f"<title>{draw(body)}</title>", f"<description>{draw(body)}</description>", draw(st.sampled_from(["", "<title2/>", "<item2><item>x</item></item2>"]))]
    parts.append(draw(st.sampled_from(["", "<tt:locations/>", "<tt:locations><tt:location><tt:city>A</tt:city></tt:location><tt:location><tt:city>B</tt:city><tt:country>Brasil</tt:country></tt:location></tt:locations>"])))
    parts += draw(st.lists(comment, max_size=2))
    return "<item" + draw(st.sampled_from(["", " a='1>0'", "\n"])) + ">" + "".join(draw(st.permutations(parts))) + "</item >"


@st.composite
def feed(draw):
    inside = draw(st.lists(st.one_of(item(), comment, st.just("<title>Jobs</title>"), st.just("<image><item><guid>deep</guid></item></image>"), st.just("\n")), max_size=4))
    head = draw(st.sampled_from(["", "<?xml version='1.0'?>", "<?xml version='1.0'?><!-- <channel> -->", "<!DOCTYPE rss>"]))
    return f"{head}<rss xmlns:tt='{NS}'>{draw(st.sampled_from(['', '<item><guid>out</guid></item>']))}<channel>{''.join(inside)}</channel></rss>"


@given(st.lists(feed(), min_size=1, max_size=12))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
def test_feeds_as_an_xml_parser_reads_them(spark, feeds):
    want = [r for k, f in enumerate(feeds) for r in plain(f, f"c{k}")]
    assert got(parsed(spark, *feeds)) == sorted(want, key=repr)


WHOLE = "<rss><channel><item><guid>1</guid><title><![CDATA[a </item> b]]></title></item></channel></rss>"


def test_a_section_that_holds_the_end_of_an_item(spark):
    r = parsed(spark, WHOLE).first()
    assert (r.id, r.title) == ("1", "a </item> b") and r.raw == WHOLE[len("<rss><channel>") : -len("</channel></rss>")]


@pytest.mark.parametrize("broken", [WHOLE[:-6], WHOLE.replace("</item></channel>", "</channel>"), WHOLE.replace("]]>", ""), "<rss/>", "", "no feed", "<rss><channel>a < b</channel></rss>", "</channel><channel>"])
def test_feeds_that_are_not_whole_stop_the_load(spark, broken):
    with pytest.raises(Exception, match="no whole channel"):
        parsed(spark, broken).collect()


def test_feeds_without_items(spark):
    assert parsed(spark, "<rss><channel/></rss>", "<rss><channel><title>x</title></channel></rss>").count() == 0

"""Text functions as Column expressions; all stay inside the JVM's generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space, spelled so that Java and RE2 read it alike.
UNICODE_SPACE = r"[\t-\r\x{85}\p{Z}]"
#: What ``\s`` means in RE2: Java's would add the vertical tab.
ASCII_SPACE = r"[\t\n\f\r ]"

# Entities that feeds use, in the order in which they are replaced.
ENTITIES = [
    ("&nbsp;", " "), ("&zwj;", ""),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#43;", "+"),
    ("&rsquo;", "'"), ("&lsquo;", "'"), ("&ldquo;", '"'), ("&rdquo;", '"'), ("&acute;", "'"),
    ("&mdash;", "—"), ("&ndash;", "–"), ("&middot;", "·"), ("&bull;", "•"),
    ("&reg;", "®"), ("&trade;", "™"), ("&euro;", "€"), ("&pound;", "£"), ("&times;", "×"),
    ("&aacute;", "á"), ("&agrave;", "à"), ("&acirc;", "â"), ("&atilde;", "ã"),
    ("&eacute;", "é"), ("&egrave;", "è"), ("&ecirc;", "ê"),
    ("&iacute;", "í"), ("&iuml;", "ï"),
    ("&oacute;", "ó"), ("&ograve;", "ò"), ("&ocirc;", "ô"), ("&otilde;", "õ"),
    ("&uacute;", "ú"), ("&ugrave;", "ù"), ("&ccedil;", "ç"), ("&ntilde;", "ñ"),
    ("&Aacute;", "Á"), ("&Agrave;", "À"), ("&Acirc;", "Â"), ("&Atilde;", "Ã"),
    ("&Eacute;", "É"), ("&Ecirc;", "Ê"), ("&Iacute;", "Í"),
    ("&Oacute;", "Ó"), ("&Ocirc;", "Ô"), ("&Otilde;", "Õ"), ("&Uacute;", "Ú"), ("&Ccedil;", "Ç"),
    ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Ouml;", "Ö"), ("&szlig;", "ß"),
]


def trim_all(c: Column) -> Column:
    """Strip every kind of Unicode white space from both ends."""
    return F.regexp_replace(c, f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")


#: So many are replaced one by one: the first two may join what stands around them to another entity, the next fill escaped HTML.
_ONE_BY_ONE = 8
_RARE = {name[1:-1]: char for name, char in ENTITIES[_ONE_BY_ONE:]}
_LONGEST = max(map(len, _RARE)) + 1


def decoded(c: Column) -> Column:
    """Entities become their characters, as if replaced one after the other and the ampersand last.

    Texts that hold a rare entity are cut at their ampersands; a piece that begins with a known name and a
    semicolon gives the name's character.  So no text is read once for each entity there is to know.
    """
    usual = reduce(lambda e, pair: F.replace(e, F.lit(pair[0]), F.lit(pair[1])), ENTITIES[:_ONE_BY_ONE], c)
    known = F.create_map(*[F.lit(x) for pair in _RARE.items() for x in pair])

    def piece(p: Column) -> Column:
        end = F.locate(";", F.substring(p, 1, _LONGEST))
        char = F.when(end > 1, F.try_element_at(known, F.substring(p, F.lit(1), end - 1)))
        return F.coalesce(F.concat(char, F.substring(p, end + 1, F.length(p))), F.concat(F.lit("&"), p))

    def whole(text: Column) -> Column:
        pieces = F.split(text, "&", -1)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), piece), ""))

    rare = "&(?:" + "|".join(_RARE) + ");"
    # The array binds the text, which is used more than once, so that it is made once.
    bound = F.transform(F.array(usual), lambda text: F.when(F.rlike(text, F.lit(rare)), whole(text)).otherwise(text))
    return F.replace(F.get(bound, F.lit(0)), F.lit("&amp;"), F.lit("&"))


def html_to_text(c: Column) -> Column:
    """Tags become spaces, entities their characters, space is collapsed and trimmed."""
    plain = decoded(F.regexp_replace(c, "<[^>]+>", " "))
    return trim_all(F.regexp_replace(plain, ASCII_SPACE + "+", " "))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def matches(c: Column, pattern: str) -> Column:
    """Whether the pattern occurs anywhere; write ``\\z`` for the end of the text."""
    return c.rlike(pattern)


def first_match(c: Column, pattern: str) -> Column:
    """The first whole match, null if there is none."""
    return F.regexp_substr(c, F.lit(pattern))


def last_piece(c: Column, separators: str, sep: str = ",") -> Column:
    """The trimmed last piece of a text after turning ``separators`` (a pattern) into ``sep``."""
    return trim_all(F.try_element_at(F.split(F.regexp_replace(c, separators, sep), sep, -1), F.lit(-1)))


def join_sections(*parts: Column, sep: str = "\n\n") -> Column:
    """Parts that are neither null nor empty, joined; null if none is left."""
    return empty_to_null(F.array_join(F.array(*map(empty_to_null, parts)), sep))


def path_piece(c: Column, n: int) -> Column:
    """Piece ``n`` (from 1) of a path that is relative to the landing folder."""
    return F.split_part(c, F.lit("/"), F.lit(n))


def percent_decoded(c: Column) -> Column:
    """Decode ``%20`` and the like; a plus sign stays a plus sign, a broken code leaves null."""
    return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def titled(c: Column) -> Column:
    """A slug as a title: ``-`` and ``_`` become spaces, a letter after a non-letter is a capital."""
    lowered = F.lower(F.translate(c, "-_", "  "))
    chars = F.split(lowered, "")
    lifted = F.transform(
        chars, lambda x, i: F.when((i == 0) | ~F.get(chars, i - 1).rlike(r"\p{L}"), F.upper(x)).otherwise(x)
    )
    return F.array_join(lifted, "")


def thousands(amount: Column) -> Column:
    """A whole number with thousands separators; halves round away from zero."""
    return F.format_number(F.round(amount, 0), 0)


def pay_label(low: Column, high: Column, currency: Column, interval: Column) -> Column:
    """``1,000 - 2,000 EUR / year``; ``?`` for what is missing, null if both amounts are."""
    label = F.concat(
        F.coalesce(thousands(low), F.lit("?")), F.lit(" - "), F.coalesce(thousands(high), F.lit("?")), F.lit(" "),
        F.coalesce(currency, F.lit("")), F.lit(" / "), F.coalesce(interval, F.lit("?")),
    )
    return F.when(low.isNotNull() | high.isNotNull(), label)


def spoken(c: Column) -> Column:
    """``full_time`` as ``Full time``."""
    plain = F.replace(c, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, 2, 1 << 30)))

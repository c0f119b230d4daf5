"""HTML expressions over landed pages (Column -> Column).

Tags are recognised by pattern, inside the JVM, so a page never leaves the
scan. A new <p> closes the one before it, as HTML5 has it.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette import constants as C
from gazette.functions.text import SPACE, collapse_space, strip_space

# Markup ends up as this character while text nodes are being joined.
_MARK = "\x01"
# Attributes of a tag: a quoted value may hold a closing bracket.
_INSIDE = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""


def _element(name: str) -> str:
    """An element with its content, without the opening bracket; unclosed, the rest."""
    return rf"{name}\b(?:{_INSIDE}>|[^>]*>).*?(?:</{name}\s*>|\z)"


def _markup(*forms: str) -> str:
    """Any of the forms after one bracket, which is what the search looks for."""
    return f"(?is)<(?:{'|'.join(forms)})"


_COMMENT = r"!--.*?(?:-->|\z)"
# the second form is for tags with a quote that does not end
_TAGS = [f"/?[a-z]{_INSIDE}>", "/?[a-z][^>]*>", "[!?][^>]*>"]
DROPPED_ELEMENTS = ["script", "style", "noscript"]
# Elements whose text a reader does not see as part of the page.
UNSEEN_ELEMENTS = ["script", "style", "template", "rt", "rp"]

BOILERPLATE = _markup(_COMMENT, *map(_element, DROPPED_ELEMENTS))
UNSEEN_OR_TAG = _markup(_COMMENT, *map(_element, UNSEEN_ELEMENTS), *_TAGS)
TAG = _markup(*_TAGS)
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>"
PARAGRAPH_END = "(?is)</(?:p|article|section|div|body)>"


def drop_boilerplate(page: Column) -> Column:
    """Page without script, style and noscript elements and without comments."""
    return F.regexp_replace(page, BOILERPLATE, "")


# The standard's character references, as text of (name, character) pairs. Some
# old names count without a semicolon too.
_NAMED_PAIRS = "\x1e".join(f"{name}\x1f{char}" for name, char in html.entities.html5.items())
_OLD_NAMES = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
_NUMBERED = "#[0-9]+;?|#[xX][0-9a-fA-F]+;?"
_REFERENCE = f"&(?:{_NUMBERED}|[A-Za-z][A-Za-z0-9]*;|(?:{'|'.join(_OLD_NAMES)}))"
_REFERENCE_IN_ATTRIBUTE = f"&(?:{_NUMBERED}|[A-Za-z][A-Za-z0-9]*;)"
# The standard reads the numbers 128 to 159 as characters of this code page.
_OLD_NUMBERS = {
    n: char for n in range(128, 160) if (char := bytes([n]).decode("cp1252", "ignore"))
}
_REPLACEMENT = "\ufffd"


def _entity_char(ref: Column) -> Column:
    """The character of one &name; or &#number; reference, null if unknown."""
    body = F.regexp_replace(ref, "^&", "")
    digits = F.regexp_replace(body, "^#[xX]?0*|;$", "")
    hexadecimal = body.rlike("^#[xX]")
    # no number of more digits is a character
    number = F.when(
        F.length(digits) <= 7,
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("int"),
    )
    utf32 = F.unhex(F.lpad(F.hex(number), 8, "0"))
    named = F.str_to_map(F.lit(_NAMED_PAIRS), F.lit("\x1e"), F.lit("\x1f"))
    old = F.create_map(*[F.lit(x) for pair in _OLD_NUMBERS.items() for x in pair])
    numeric = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    character = (
        F.when(number.between(128, 159), F.coalesce(F.try_element_at(old, number), F.decode(utf32, "UTF-32")))
        .when(numeric, F.decode(utf32, "UTF-32"))
        .otherwise(_REPLACEMENT)
    )
    return F.when(body.startswith("#"), character).otherwise(F.try_element_at(named, body))


def _decode_each(text: Column, pattern: str) -> Column:
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    pairs = F.transform(refs, lambda r: F.struct(r.alias("ref"), _entity_char(r).alias("c")))
    known = F.filter(pairs, lambda p: p["c"].isNotNull())
    # '&' itself comes last, so nothing decodes twice; a name goes before its beginning
    ordered = F.array_sort(
        F.transform(
            known,
            lambda p: F.struct(
                (p["c"] == "&").alias("amp"), (-F.length(p["ref"])).alias("n"), p["ref"], p["c"]
            ),
        )
    )
    return F.aggregate(ordered, text, lambda acc, p: F.replace(acc, p["ref"], p["c"]))


def decode_entities(text: Column, pattern: str = _REFERENCE) -> Column:
    """Replace character references; text without any passes through."""
    # through an array of one, so that the text is worked out only once
    decoded = F.transform(
        F.array(text),
        lambda t: F.when(F.contains(t, F.lit("&")), _decode_each(t, pattern)).otherwise(t),
    )
    return F.get(decoded, 0)


def visible_text(page: Column) -> Column:
    """Text nodes of a page, each stripped, joined by one space."""
    marked = decode_entities(F.regexp_replace(page, UNSEEN_OR_TAG, _MARK))
    joined = F.regexp_replace(marked, f"(?U)[{SPACE}]*{_MARK}[{SPACE}{_MARK}]*", " ")
    return strip_space(joined)


def html_to_text(page: Column) -> Column:
    """Visible text with white space collapsed; '' for null."""
    spaced = decode_entities(F.regexp_replace(page, UNSEEN_OR_TAG, " "))
    return F.coalesce(collapse_space(spaced), F.lit(""))


def _fragment_text(fragment: Column) -> Column:
    return collapse_space(decode_entities(F.regexp_replace(fragment, TAG, " ")))


def paragraph_fragments(clean_page: Column) -> Column:
    """Inner markup of every paragraph, in page order."""
    pieces = F.split(clean_page, PARAGRAPH)
    inner = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    return F.transform(inner, lambda p: F.split(p, PARAGRAPH_END, 2)[0])


def paragraph_texts(clean_page: Column) -> Column:
    """Paragraph texts longer than the minimum, at most the first thirty."""
    texts = F.transform(paragraph_fragments(clean_page), _fragment_text)
    return F.slice(
        F.filter(texts, lambda t: F.length(t) > C.MIN_PARAGRAPH_CHARS), 1, C.MAX_PARAGRAPHS
    )


def paragraph_html(clean_page: Column) -> Column:
    """Markup of the first thirty paragraphs, one per line."""
    opens = F.regexp_extract_all(clean_page, F.lit(PARAGRAPH), F.lit(0))
    whole = F.zip_with(
        opens, paragraph_fragments(clean_page), lambda tag, p: F.concat(tag, p, F.lit("</p>"))
    )
    return F.array_join(F.slice(whole, 1, C.MAX_PARAGRAPHS), "\n")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in a tag, '' if there is none."""
    pattern = rf"(?is)(?<![\w-]){name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    value = F.regexp_replace(F.regexp_extract(tag, pattern, 1), "^[\"']|[\"']\\z", "")
    return decode_entities(value, _REFERENCE_IN_ATTRIBUTE)


def _first_tag(page: Column, tag: str, attribute: str, value: str) -> Column:
    """The first tag with the value among those of the attribute, quoted or not."""
    word = rf"(?<![\w:-]){value}(?![\w:-])"
    held = rf"(?:\"[^\">]*{word}[^\">]*\"|'[^'>]*{word}[^'>]*'|{value}(?=[\s/>]))"
    pattern = rf"(?is)<{tag}\b[^>]*?(?<![\w-]){attribute}\s*=\s*{held}{_INSIDE}>"
    return F.regexp_extract(page, pattern, 0)


def meta_content(page: Column, key: str) -> Column:
    """Content of <meta property=key>, or of <meta name=key> without the former."""
    by_property = _first_tag(page, "meta", "property", key)
    by_name = _first_tag(page, "meta", "name", key)
    return _attribute(F.when(by_property != "", by_property).otherwise(by_name), "content")


def canonical_url(page: Column) -> Column:
    """og:url if it has a value, else the canonical link, else ''."""
    og_url = meta_content(page, "og:url")
    link = _attribute(_first_tag(page, "link", "rel", "canonical"), "href")
    return F.when(og_url != "", og_url).otherwise(link)


def title_tag(page: Column) -> Column:
    """Text of the <title> element, null if there is none."""
    whole = F.regexp_extract(page, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 0)
    inner = F.regexp_replace(whole, r"(?is)^<title\b[^>]*>|</title\s*>\z", "")
    return F.when(whole != "", decode_entities(inner))


def clean_title(candidate: Column) -> Column:
    """Collapsed title, cut before the first ' - ', ' | ' or ' — '."""
    return F.regexp_replace(
        F.coalesce(collapse_space(candidate), F.lit("")), r" [-|—] .*$", ""
    )


def usable_title(title: Column) -> Column:
    """True for titles that look like a headline rather than a menu entry."""
    low = F.lower(title)
    menu_words = F.lit(False)
    for word in C.TITLE_BLACKLIST:
        menu_words = menu_words | F.contains(low, F.lit(word))
    words = F.size(F.split(title, " "))
    return (
        (F.length(title) >= C.MIN_TITLE_CHARS)
        & ~low.isin(C.TITLE_BLACKLIST)
        & ~((words <= 2) & menu_words)
        & title.rlike(r"[a-zA-ZÀ-ÿ]")
    )


def best_title(page: Column, feed_title: Column) -> Column:
    """First usable of og:title, <title> and feed title; else the feed title."""
    og_title = F.nullif(meta_content(page, "og:title"), F.lit(""))
    candidates = F.array_compact(F.array(og_title, title_tag(page), feed_title))
    cleaned = F.transform(candidates, clean_title)
    return F.coalesce(F.get(F.filter(cleaned, usable_title), 0), clean_title(feed_title))

"""Tags and attributes of stored HTML, and the image link rules by site."""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The states of an HTML tokenizer, written as one regex over its tokens, so that a
# scan of a page starts every token where the one before it ended. Everything is
# possessive: a huge or broken tag costs neither stack nor time.
SPACE = r"[\t\n\f\r ]"
NAME_END = r"(?=[\t\n\f\r />])"
# A name, and perhaps a value: quoted, bare (bare ones may hold quotes), or missing.
ATTRIBUTE = (
    rf"""([^\t\n\f\r />][^\t\n\f\r />=]*+)"""
    rf"""(?:{SPACE}*+={SPACE}*+("[^"]*+"|'[^']*+'|[^\t\n\f\r >"'][^\t\n\f\r >]*+)?+)?+"""
)
CLOSED = (
    rf"""(?:[\t\n\f\r /]++|[^\t\n\f\r />][^\t\n\f\r />=]*+"""
    rf"""(?:{SPACE}*+={SPACE}*+(?:"[^"]*+"|'[^']*+'|(?=>)|[^\t\n\f\r >"'][^\t\n\f\r >]*+)|(?!{SPACE}*+=)))*+>"""
)
# As a closed tag, or to the end of the page, where the page ends within a tag.
OPEN = (
    rf"""(?:[\t\n\f\r /]++|[^\t\n\f\r />][^\t\n\f\r />=]*+"""
    rf"""(?:{SPACE}*+={SPACE}*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|(?=>)|\z|[^\t\n\f\r >"'][^\t\n\f\r >]*+))?+)*+(?:>|\z)"""
)
COMMENT = r"!--(?:-?>|.*?(?:--!?>|\z))|[!?][^>]*+(?:>|\z)|/>|/[^a-z][^>]*+(?:>|\z)"
# Elements whose content is text up to their own end tag.
TEXT_ELEMENTS = ("style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
TEXT = {name: rf"(?:[^<]++|(?!</{name}{NAME_END})<)*+" for name in TEXT_ELEMENTS}
# In a script, "<!--" opens a part in which a whole "<script>..</script>" is text too.
_INNER = rf"<script{NAME_END}(?:[^<-]++|(?!-->|</script{NAME_END})[<-])*+(?:</script{NAME_END}|(?=-->)|\z)"
_ESCAPED = rf"<!(?=--)(?:[^<-]++|{_INNER}|(?!-->|</script{NAME_END})[<-])*+(?:-->|(?=</script{NAME_END})|\z)"
TEXT["script"] = rf"(?:[^<]++|{_ESCAPED}|(?!</script{NAME_END})<)*+"
TEXT["plaintext"] = r".*+"

# The sites with rules of their own, in the order they are tried: what
# the page's URL holds ("" is any), the attribute with the link, one of the marks the
# link holds, and a further one.
SITES = (
    ("me.me", "src", ("jpg", "png", "gif"), "http"),
    ("doutu", "data-original", ("jpg", "png", "gif"), "http"),
    ("jandan", "src", ("jpg", "png"), "w"),
    ("jandan", "org_src", ("gif",), "w"),
    ("", "src", ("jpg", "png", "gif"), "http"),
)

# Named characters, from the standard's list; some old names need no ";". Numbers
# 128-159 stand for the letters of the Windows code page, where it has any.
NAMED = json.dumps({name[:-1]: text for name, text in html5.items() if name.endswith(";")})
OLD_NAMED = json.dumps({name: text for name, text in html5.items() if not name.endswith(";")})
WINDOWS = json.dumps({n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)})


def token_regex(tag: str) -> str:
    """One token of a page that is not text; group 1 holds what follows the name of a ``tag``."""
    wanted = rf"{tag}{NAME_END}({CLOSED}){TEXT.get(tag, '')}"
    texts = "|".join(rf"{name}{NAME_END}{CLOSED}{content}" for name, content in TEXT.items() if name != tag)
    return rf"(?is)<(?:{wanted}|{texts}|{COMMENT}|/?[a-z][^\t\n\f\r />]*+{OPEN})"


def tags_of(html: Column, tag: str) -> Column:
    """The attributes' text of all opening tags of one kind, in document order.

    What only looks like a tag is none: ``<img-box>`` is no ``<img>``, and neither is
    one within a comment, another tag's attribute, a script or another element whose
    content is text, nor one that the page's end cuts off. Elements of embedded
    drawings are taken for those of the page.
    """
    found = F.regexp_extract_all(html, F.lit(token_regex(tag.lower())), F.lit(1))
    return F.filter(found, lambda t: t != "")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def attributes_of(tag: Column) -> Column:
    """``struct<names, values>``: the attributes of a tag, names with A-Z lowered.

    An attribute without a value has an empty one.
    """
    names = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(1))
    values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(2))
    lowered = F.transform(names, lambda n: F.translate(n, UPPER, UPPER.lower()))
    return F.struct(lowered.alias("names"), F.transform(values, _plain_value).alias("values"))


def _plain_value(raw: Column) -> Column:
    quoted = raw.startswith('"') | raw.startswith("'")
    value = F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
    return F.when(F.contains(value, F.lit("&")), unescape(value)).otherwise(value)


def unescape(text: Column) -> Column:
    """An attribute's text with its character references resolved: named ones, which
    end in ``;``, and numbers in either base, with or without it. Old names need no
    ``;`` either, unless ``=`` or a letter or digit follows, as in the next field of a
    link. Unknown ones stay as they are."""
    parts = F.split(text, "&")
    named = F.from_json(F.lit(NAMED), "map<string,string>")
    old_named = F.from_json(F.lit(OLD_NAMED), "map<string,string>")
    windows = F.from_json(F.lit(WINDOWS), "map<string,string>")

    def number(part: Column, regex: str, base: int) -> Column:
        # Nine digits are beyond any character and still fit.
        digits = F.substring(F.regexp_extract(part, regex, 1), 1, 9)
        return F.conv(digits, base, 10).cast("long")

    def character(code: Column) -> Column:
        wrong = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(wrong, F.lit("\ufffd")).otherwise(F.coalesce(windows[code.cast("string")], plain))

    def resolved(part: Column) -> Column:
        hexadecimal, decimal, name = r"^#[xX]0*([0-9a-fA-F]+);?", r"^#0*([0-9]+);?", r"^([A-Za-z][A-Za-z0-9]*);"
        old_name = r"^([A-Za-z][A-Za-z0-9]*+)(?![;=])"
        zero = part.rlike(r"^#([xX])?0+(;|[^0-9a-fA-F]|$)")
        found = named[F.regexp_extract(part, name, 1)]
        old = old_named[F.regexp_extract(part, old_name, 1)]
        rest = lambda regex: F.regexp_replace(part, regex, "")
        return (
            F.when(zero, F.concat(F.lit("\ufffd"), rest(r"^#[xX]?0+;?")))
            .when(part.rlike(hexadecimal), F.concat(character(number(part, hexadecimal, 16)), rest(hexadecimal)))
            .when(part.rlike(decimal), F.concat(character(number(part, decimal, 10)), rest(decimal)))
            .when(found.isNotNull(), F.concat(found, rest(name)))
            .when(old.isNotNull(), F.concat(old, rest(old_name)))
            .otherwise(F.concat(F.lit("&"), part))
        )

    tail = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), resolved)
    return F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))


def attribute(attributes: Column, name: str) -> Column:
    """Value of one attribute, of several the first; NULL when the tag has no such attribute."""
    place = F.nullif(F.array_position(attributes["names"], name), F.lit(0)).cast("int")
    return F.get(attributes["values"], place - 1)


def _has(text: Column, marks: tuple[str, ...], also: str) -> Column:
    """One of the marks and the further one are in the text."""
    found = F.lit(False)
    for mark in marks:
        found = found | text.contains(mark)
    return found & text.contains(also)


def image_link(url: Column, links: dict[str, Column]) -> Column:
    """Link to download for one image tag, NULL to skip it; the first rule wins.

    ``links`` are the tag's attributes by name. Where a rule needs another
    attribute than ``src`` and the tag lacks it, the tag is skipped and no later
    rule is tried.
    """
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for site, name, marks, also in SITES:
        here, link = url.contains(site) if site else F.lit(True), links[name]
        if name != "src":
            chosen = chosen.when(here & link.isNull(), F.lit(None))
        chosen = chosen.when(here & _has(link, marks, also), link)
    return chosen

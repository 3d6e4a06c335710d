"""HTML columns on regular expressions: head, metas, title, text, attributes.

These read regular markup without leaving the JVM. Pages with broken markup go through the
tolerant parser in :mod:`crawlspark.operators.tolerant`.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from crawlspark.functions.let import let

_ATTR = r"""([^\s=>"'/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
#: what stands in a tag before its ">": quotes count after an equals sign, where they hide a ">"
INNER = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
# Each pattern starts with one "<" outside its branches: the matcher skips text at full speed.
# comments, and script or style blocks with their content; what is not closed goes on to the end
_COMMENT = r"!--.*?(?:-->|\z)"
_BLOCK = rf"(script|style)\b{INNER}>.*?(?:</\1\s*>|\z)"
_HIDDEN = rf"(?is)<(?:{_COMMENT}|{_BLOCK})"
_TAG = rf"(?is)<[!/?a-z]{INNER}(?:>|\z)"
_MARKUP = rf"(?is)<(?:{_COMMENT}|{_BLOCK}|[!/?a-z]{INNER}(?:>|\z))"
_HOLLOW = rf"(?is)(?=<)(?:<{_COMMENT}|(<(script|style)\b{INNER}>).*?(</\2\s*>|\z))"
#: elements that part text into blocks
_BLOCKS = (
    "address|article|aside|blockquote|body|center|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav"
    "|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
)


def attr_names(attrs: Column) -> Column:
    """Lower-cased attribute names of a tag, aligned with :func:`attr_values`."""
    return F.regexp_extract_all(F.lower(attrs), F.lit(_ATTR), 1)


def attr_values(attrs: Column) -> Column:
    return F.regexp_extract_all(attrs, F.lit(_ATTR), 2)


def attr_arrays(attrs: Column) -> Column:
    return F.struct(attr_names(attrs).alias("names"), attr_values(attrs).alias("values"))


def pick_attr(names: Column, values: Column, name: str) -> Column:
    """Value of the first attribute with that name, references still encoded; null when absent."""
    raw = F.get(values, (F.array_position(names, name) - 1).cast("int"))
    return F.regexp_replace(raw, r"""^["']|["']$""", "")


def attr(attrs: Column, name: str) -> Column:
    """Decoded value of one attribute of a tag's attribute text; null when absent."""
    return decode_entities(pick_attr(attr_names(attrs), attr_values(attrs), name), attribute=True)


def _table(pairs: dict[str, str]) -> Column:
    """A constant map; an ampersand stays encoded for the last step of decoding."""
    text = "\u0002".join(f"{name}\u0001{value.replace('&', '&amp;')}" for name, value in sorted(pairs.items()))
    return F.str_to_map(F.lit(text), F.lit("\u0002"), F.lit("\u0001"))


# the usual names are looked up first: a map is searched from its start
_USUAL = {f"{name};": chr(cp) for name, cp in name2codepoint.items()}
_ALL = {name: value for name, value in html5.items() if name.endswith(";")}
#: names that need no semicolon, longest first
_OLD = {name: value for name, value in html5.items() if not name.endswith(";")}
_OLD_NAME = "^(?:" + "|".join(sorted(_OLD, key=lambda name: (-len(name), name))) + ")"
_REFERENCE = r"^(?:#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;?)"
#: numeric references to these mean characters of windows-1252 (fixed by the HTML standard)
_WINDOWS = {str(n): bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}


def decode_entities(text: Column, attribute: bool = False) -> Column:
    """Decode character references as the HTML standard reads them; nothing decodes twice.

    Old names need no semicolon; in an attribute they need one if ``=``, a letter or a digit follows.
    ``&amp;``, by far the most frequent, stays as it is until everything else is decoded.
    """

    def piece(p: Column, i: Column) -> Column:
        whole = F.concat(F.lit("&"), p)

        def old(ref: Column, name: Column) -> Column:
            rest = F.substr(p, F.length(name) + 1)
            decoded = F.concat(F.try_element_at(_table(_OLD), name), rest)
            stays = name == ""
            if attribute:
                stays = stays | rest.rlike("^[=A-Za-z0-9]")
            return F.when(stays, whole).otherwise(decoded)

        def named(ref: Column) -> Column:
            rest = F.substr(p, F.length(ref) + 1)
            char = F.coalesce(F.try_element_at(_table(_USUAL), ref), F.try_element_at(_table(_ALL), ref))
            return (
                F.when(ref == "", whole)
                .when(ref.startswith("#"), F.concat(_numeric(ref), rest))
                .otherwise(
                    F.coalesce(F.when(ref.endswith(";"), F.concat(char, rest)), let(F.regexp_extract(ref, _OLD_NAME, 0), lambda name: old(ref, name)))
                )
            )

        return F.when(i == 0, p).otherwise(let(F.regexp_extract(p, _REFERENCE, 0), named))

    def decoded(t: Column) -> Column:
        others = F.array_join(F.transform(F.split(t, "&(?!amp;)"), piece), "")
        return F.when(t.contains("&"), F.replace(others, F.lit("&amp;"), F.lit("&"))).otherwise(t)

    return let(text, decoded)


def _numeric(ref: Column) -> Column:
    """The character of ``#65;`` or ``#x41;``, however many zeros lead."""
    digits = F.regexp_replace(ref, "^#[xX]?0*|;$", "")
    base16 = ref.rlike("^#[xX]")
    code = F.when(F.length(digits) > 7, F.lit(-1)).otherwise(
        F.when(base16, F.conv(digits, 16, 10)).otherwise(F.when(digits == "", "0").otherwise(digits)).try_cast("int")
    )
    return let(F.coalesce(code, F.lit(0)), _code_point)


def _code_point(code: Column) -> Column:
    # UTF-32BE bytes of one code point; 0, surrogates and out-of-range values become U+FFFD,
    # an ampersand stays encoded for the last step
    bad = (code <= 0) | (code > 1114111) | code.between(55296, 57343)
    return (
        F.when(bad, F.lit("\ufffd"))
        .when(code == 38, F.lit("&amp;"))
        .when(code.between(128, 159), F.coalesce(F.try_element_at(_table(_WINDOWS), code.cast("string")), F.chr(code)))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def strip_hidden(html: Column) -> Column:
    """Html without comments, script and style blocks."""
    return F.regexp_replace(html, _HIDDEN, "")


def hollow(html: Column) -> Column:
    """Html without comments and without the content of scripts and styles; their tags stay."""
    return F.regexp_replace(html, _HOLLOW, "$1$3")


def head_of(html: Column) -> Column:
    """Everything before the body starts, without comments, scripts and styles.

    A ``<body`` inside of those does not count: then the hidden parts of the whole page go first.
    """
    def before_body(text: Column) -> Column:
        return F.get(F.split(text, r"(?i)<body(?=[\s/>])", 2), F.lit(0))

    def cut(first: Column) -> Column:
        hidden = F.regexp_replace(first, _CLOSED, "").rlike(r"(?i)<(?:!--|(?:script|style)\b)")
        return F.when(hidden, before_body(strip_hidden(html))).otherwise(strip_hidden(first))

    return let(before_body(html), cut)


_CLOSED = rf"(?is)<(?:!--.*?-->|(script|style)\b{INNER}>.*?</\1\s*>)"


def collapse(text: Column) -> Column:
    """Whitespace runs to one blank, ends trimmed."""
    # single blanks, the usual case, are left alone
    return F.trim(F.regexp_replace(text, r"\s(?:\s+|(?<! ))", " "))


def bare_text(html: Column) -> Column:
    """Text nodes outside hidden blocks, parted by blanks, references still encoded."""
    return F.regexp_replace(html, _MARKUP, " ")


def drop_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, _TAG, " ")


def bare_title(head: Column) -> Column:
    """Title markup of a head, ``''`` if there is none."""
    return drop_tags(F.regexp_extract(head, rf"(?is)<title\b{INNER}>(.*?)</title\s*>", 1))


def readable(bare: Column) -> Column:
    """Bare text with references decoded and whitespace collapsed."""
    return collapse(decode_entities(bare))


def metas_of(head: Column) -> Column:
    """The meta tags of a head in order, as structs of lower-cased names and the content."""
    return F.transform(F.regexp_extract_all(head, F.lit(rf"(?is)<meta\b({INNER})>"), 1), _meta)


def _meta(attrs: Column) -> Column:
    def picked(a: Column) -> Column:
        return F.struct(
            F.lower(pick_attr(a["names"], a["values"], "name")).alias("name"),
            F.lower(pick_attr(a["names"], a["values"], "http-equiv")).alias("equiv"),
            decode_entities(pick_attr(a["names"], a["values"], "content"), attribute=True).alias("content"),
            pick_attr(a["names"], a["values"], "charset").alias("charset"),
            F.lower(pick_attr(a["names"], a["values"], "property")).alias("property"),
        )

    return let(attr_arrays(attrs), picked)


def article_html(html: Column) -> Column:
    """Content of all article elements, nested ones within theirs; ``''`` if there is none.

    An article that is not closed goes on to the end.
    """
    pieces = F.split(strip_hidden(html), r"(?i)(?=</?article(?=[\s/>]))")
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, piece: Column) -> Column:
        change = F.when(piece.rlike(r"(?i)^</article"), -1).when(piece.rlike(r"(?i)^<article"), 1).otherwise(0)

        def next_(depth: Column) -> Column:
            parts = F.when(depth > 0, F.concat(acc["parts"], F.array(piece))).otherwise(F.concat(acc["parts"], F.array(F.lit(" "))))
            return F.struct(depth.alias("depth"), parts.alias("parts"))

        return let(F.greatest(acc["depth"] + change, F.lit(0)), next_)

    return F.trim(F.array_join(F.aggregate(pieces, start, step, lambda acc: acc["parts"]), ""))


def body_of(html: Column) -> Column:
    """Markup after the body's own tag, or all of it, without hidden parts."""
    shown = strip_hidden(html)
    return F.coalesce(F.get(F.split(shown, rf"(?i)<body(?=[\s/>]){INNER}(?:>|\z)", 2), F.lit(1)), shown)


def prose_html(html: Column, min_words: int, max_link_share: float) -> Column:
    """Blocks of the body with enough words of which few are in links, parted by blanks."""
    blocks = F.split(body_of(html), rf"(?i)<(?:/?(?:{_BLOCKS})(?=[\s/>]){INNER}(?:>|\z))")

    def words(markup: Column) -> Column:
        bare = F.trim(F.regexp_replace(drop_tags(markup), r"\s+", " "))
        return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " ")))

    def linked(block: Column) -> Column:
        return words(F.array_join(F.regexp_extract_all(block, F.lit(rf"(?is)<a(?=[\s/>]){INNER}>(.*?)(?:</a\s*>|\z)"), 1), " "))

    def prose(block: Column) -> Column:
        return let(words(block), lambda n: (n >= min_words) & (linked(block) <= n * F.lit(max_link_share)))

    return F.array_join(F.filter(blocks, prose), " ")

"""Elements of an HTML fragment, as column expressions over its tokens (tags and texts).

A fragment is cut into tokens once; an element is found by a fold over them that tracks how deep tags of its name
are nested, so it ends at its own closing tag whatever stands inside it. Attribute values may have double, single
or no quotes, in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinio.functions.text import once

# A comment, a tag (quoted values may hold ">"), a run of text, or a "<" that opens no tag.
TOKEN = r"""(?s)<!--.*?-->|<[A-Za-z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""
TAG_NAME = r"^<(/?[A-Za-z][A-Za-z0-9]*|[!?/])"


def tokens_of(html: Column, marks: dict[str, tuple[str, str]]) -> Column:
    """array of struct(text, name, mark): the tags and texts of a fragment, in order.

    ``name`` is the tag's name in lower case, with ``/`` before it in a closing tag and behind it in a tag that closes
    itself, and '' for a text. ``mark`` is the first of ``marks`` (mark -> (tag name, pattern)) that the tag matches.
    """
    def named(token: Column) -> Column:
        name = F.lower(F.regexp_extract(token, TAG_NAME, 1))
        closed = F.when(token.endswith("/>"), "/").otherwise("")
        return F.struct(token.alias("text"), F.when(token.startswith("<"), F.concat(name, closed)).otherwise("").alias("name"))

    def marked(token: Column) -> Column:
        mark = F.lit(None).cast("string")
        for k, (name, pattern) in reversed(marks.items()):
            mark = F.when((token["name"] == name) & token["text"].rlike(pattern), k).otherwise(mark)
        return F.struct(token["text"].alias("text"), token["name"].alias("name"), mark.alias("mark"))

    return F.transform(F.transform(F.regexp_extract_all(html, F.lit(TOKEN), 0), named), marked)


def _valued(value: str) -> str:
    """A whole attribute value, in double, single or no quotes."""
    return rf"""(?:"{value}"|'{value}'|{value}(?=[\s/>]))"""


def _tag(name: str, attr: str, value: str) -> str:
    return rf"""(?s)^<(?i:{name})(?=[\s/>])(?=.*?[\s"'](?i:{attr})\s*=\s*{_valued(value)}).*>$"""


def tag_with(name: str, attr: str, value: str) -> str:
    """Pattern of an opening tag whose attribute has exactly this value."""
    return _tag(name, attr, value)


def tag_with_class(name: str, token: str) -> str:
    """Pattern of an opening tag with ``token`` among its class names."""
    return _tag(name, "class", rf"""(?:[^"'>]*\s)?{token}(?:\s[^"'>]*)?""")


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute as written; '' where it has none."""
    found = [F.regexp_extract(tag, rf"""(?s)[\s"'](?i:{name})\s*=\s*{value}""", 1)
             for value in ('"([^"]*)"', "'([^']*)'", r"""([^\s"'>]+)""")]
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))


def _span(tokens: Column, opens, name: Column) -> Column:
    """struct(first, last): places of the opening tag that ``opens`` accepts first and of its own closing tag (0: none)."""
    zero = F.lit(0)

    def step(state: Column, token: Column) -> Column:
        at, first, depth, last = (state[k] for k in ("at", "first", "depth", "last"))
        inside = (first > 0) & (last == 0)
        starts, ends = (first == 0) & opens(token), inside & (token["name"] == F.concat(F.lit("/"), name))
        deeper = F.when(starts | (inside & (token["name"] == name)), 1).when(ends, -1).otherwise(0)
        return F.struct((at + 1).alias("at"), F.when(starts, at + 1).otherwise(first).alias("first"),
                        (depth + deeper).alias("depth"), F.when(ends & (depth == 1), at + 1).otherwise(last).alias("last"))

    start = F.struct(zero.alias("at"), zero.alias("first"), zero.alias("depth"), zero.alias("last"))
    return F.aggregate(tokens, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _element(tokens: Column, opens, name: Column) -> Column:
    def cut(span: Column) -> Column:
        stop = F.when(span["last"] > 0, span["last"]).otherwise(F.size(tokens) + 1)
        return F.when(span["first"] > 0, F.struct(F.get(tokens, span["first"] - 1)["text"].alias("tag"),
                                                  F.slice(tokens, span["first"] + 1, stop - span["first"] - 1).alias("inside")))

    return once(_span(tokens, opens, name), cut)


def elements(tokens: Column, marks: list[tuple[str, str]]) -> Column:
    """For each (mark, tag name) struct(tag, inside) of the first element with this mark; NULL where there is none.

    ``inside`` are the tokens up to its own closing tag, or to the end where it is never closed.
    """
    wanted = F.array(*[F.struct(F.lit(m).alias("mark"), F.lit(n).alias("name")) for m, n in marks])
    return F.transform(wanted, lambda w: _element(tokens, lambda t: t["mark"].eqNullSafe(w["mark"]), w["name"]))


def inside_first(tokens: Column, name: str, n: int) -> Column:
    """For each of the first ``n`` elements of a name the tokens inside it; NULL where there are fewer."""
    places = F.filter(F.sequence(F.lit(1), F.size(tokens)), lambda i: F.get(tokens, i - 1)["name"] == name)
    own = F.lit(name)

    def from_place(at: Column) -> Column:
        return F.when(at.isNotNull(), once(F.slice(tokens, at, F.size(tokens)),
                                           lambda rest: _element(rest, lambda t: t["name"] == own, own)["inside"]))

    def pick(places: Column) -> Column:
        return F.transform(F.array(*[F.get(places, k) for k in range(n)]), from_place)

    return once(F.when(F.size(tokens) > 0, places), pick)


def joined_text(tokens: Column) -> Column:
    """The text of tokens without tags, as written; NULL for NULL."""
    return F.array_join(F.transform(F.filter(tokens, lambda t: t["name"] == ""), lambda t: t["text"]), "")

"""Column -> Column text helpers (F2, F5, F7, F8, F9, F13, F19 and HTML helpers).

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace()),
# in code-point order. Spark's trim() removes only the space character.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex character class (usable by Java regex and RE2).
WS_CLASS = "[" + PY_WHITESPACE + "]"

# The reply-fence pattern (a ```json fence around an object).
FENCE_PATTERN = "(?s)```json" + WS_CLASS + "*(\\{.*\\})" + WS_CLASS + "*```"

# The word used when a list or a text is absent.
NONE_WORD = "无"

# The prefix of a failed labeler call.
CALL_FAILED_PREFIX = "调用接口失败"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c) -> Column:
    """Python ``str.strip()``: trim every Unicode whitespace at both ends."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def strip_fence(c) -> Column:
    """the object inside a ```json fence if there is one, else the trimmed text."""
    c = _c(c)
    inner = F.regexp_extract(c, FENCE_PATTERN, 1)
    return F.coalesce(F.nullif(inner, F.lit("")), utrim(c))


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it (also inside lambdas)."""
    return F.get(F.transform(F.array(value), use), 0)


def _numeric_entity(part: Column) -> Column:
    """The text behind one ``&#``: a decimal or hexadecimal character reference, or what it was."""
    dec = F.regexp_extract(part, r"^(\d{1,7});", 1)
    hexa = F.regexp_extract(part, r"^[xX]([0-9a-fA-F]{1,6});", 1)
    code = F.when(dec != "", dec.cast("long")).when(hexa != "", F.conv(hexa, 16, 10).cast("long"))

    def shown(code: Column) -> Column:
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
                      F.concat(char, F.regexp_replace(part, r"^[0-9a-fA-FxX]+;", ""))).otherwise(F.concat(F.lit("&#"), part))

    return once(code, shown)


def _numeric_entities(c: Column) -> Column:
    """Decimal and hexadecimal character references; others stay as they are."""
    def joined(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), _numeric_entity)
        return F.concat(F.get(parts, 0), F.array_join(rest, ""))

    return once(F.split(c, "&#"), joined)


def unescape_html(c) -> Column:
    """The basic named entities and all numeric ones; ``&amp;`` last so that ``&amp;lt;`` stays ``&lt;``."""
    def named(c: Column) -> Column:
        for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\xa0")):
            c = F.replace(c, F.lit(ent), F.lit(ch))
        return c

    def decoded(c: Column) -> Column:
        numeric = once(named(c), lambda t: F.when(t.contains("&#"), _numeric_entities(t)).otherwise(t))
        return F.when(c.contains("&"), F.replace(numeric, F.lit("&amp;"), F.lit("&"))).otherwise(c)

    return once(_c(c), decoded)


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), r"<[^>]*>", "")


def node_text(c) -> Column:
    """BeautifulSoup-style ``.text.strip()`` of an HTML fragment."""
    return utrim(unescape_html(strip_tags(c)))


def split_topics(c) -> Column:
    """F7 + P17: split a stored topics string on ASCII ',', trim, drop blanks."""
    parts = F.transform(F.split(_c(c), ","), lambda x: utrim(x))
    return F.filter(parts, lambda x: x != F.lit(""))


def clean_topic_array(c) -> Column:
    """P17 on an array: trim each element and drop the blank ones."""
    return F.filter(F.transform(_c(c), lambda x: utrim(x)), lambda x: x != F.lit(""))


def join_topics(c, empty: str = "") -> Column:
    """F8: ``", ".join(arr)``; an empty array gives ``empty`` (无 for the prompt list)."""
    c = _c(c)
    return F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise(F.lit(empty))


def strip_char(c, ch: str) -> Column:
    """``str.strip(ch)``."""
    return F.btrim(_c(c), F.lit(ch))


def numbered_line(no, text) -> Column:
    """``f"{n}: {text}"``; a missing text renders as the empty string."""
    return F.concat(_c(no).cast("string"), F.lit(": "), F.coalesce(_c(text), F.lit("")))


def hashtags(c) -> Column:
    """every ``#label#`` in order (without the hashes)."""
    return F.regexp_extract_all(_c(c), F.lit("#([^#]+)#"), 1)


def without_hashtags(c) -> Column:
    """the text outside the ``#label#`` parts, trimmed."""
    return utrim(F.regexp_replace(_c(c), "#[^#]+#", ""))


LETTERS = r"\p{L}+"
HAN = r"\p{IsHan}"


def _word_tokens(w: Column) -> Column:
    """A run of letters is one token; with Chinese characters in it, its character bigrams are."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, 2))
    return F.when(w.rlike(HAN) & (F.length(w) > 1), pairs).otherwise(F.array(w))


def tokens(c) -> Column:
    """Lower-case word tokens of every script (the tokenizer of the native labelers)."""
    low = F.lower(_c(c))
    words = F.regexp_extract_all(low, F.lit(LETTERS), 0)
    return F.when(low.rlike(HAN), F.flatten(F.transform(words, _word_tokens))).otherwise(words)


def first_token(c) -> Column:
    """The first element of ``tokens(c)`` (NULL when there is none), without building the whole array."""
    w = F.nullif(F.regexp_extract(F.lower(_c(c)), LETTERS, 0), F.lit(""))
    return F.when(w.rlike(HAN), F.substring(w, F.lit(1), F.lit(2))).otherwise(w)

"""HTML token expressions. A page is split by one regular expression pass."""

from pyspark.sql import Column, functions as F

from pagemill.functions.entities import decode_entities

_WS = r"[ \t\n\r]"
# Attribute: name, then optionally = and a quoted or bare value.
ATTRIBUTE = (
    rf"[^ \t\n\r=>/][^ \t\n\r=>]*+{_WS}*+"
    rf"(?:={_WS}*+(?:\"[^\"]*+\"?+|'[^']*+'?+|[^ \t\n\r>]*+))?+"
)
_ATTRIBUTE_PARTS = (
    rf"\A([^ \t\n\r=>/][^ \t\n\r=>]*+){_WS}*+"
    rf"(?:(=){_WS}*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^ \t\n\r>]*+)))?+"
)
_ATTRIBUTES = rf"(?:[ \t\n\r/=]|{ATTRIBUTE})*+>?+"
_RAW_OPEN = rf"<(script|style|textarea)(?=[ \t\n\r>/]){_ATTRIBUTES}"
_NAME = r"[^ \t\n\r>/]++"

# Comment | doctype | raw-text element up to its end tag | tag | text | lone "<".
TOKEN = (
    r"(?is)<!--.*?-->"
    r"|<!DOCTYPE[^>]*+>"
    rf"|{_RAW_OPEN}.*?(?:</\1>|\z)"
    rf"|(?!<!--|<!DOCTYPE)</?+{_NAME}{_ATTRIBUTES}"
    r"|[^<]++|<"
)
_RAW_PARTS = rf"(?is)\A({_RAW_OPEN})(.*?)(</\2>)?\z"


def token_array(html: Column) -> Column:
    """The page cut into token texts; joined together they are the page again."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def is_raw_element(token: Column) -> Column:
    """True for a script, style or textarea token (open tag, content and end tag in one)."""
    return token.rlike(r"(?i)\A<(?:script|style|textarea)[ \t\n\r>/]")


def raw_open(token: Column) -> Column:
    return F.regexp_extract(token, _RAW_PARTS, 1)


def raw_content(token: Column) -> Column:
    return F.regexp_extract(token, _RAW_PARTS, 3)


def raw_close(token: Column) -> Column:
    return F.regexp_extract(token, _RAW_PARTS, 4)


def is_comment(token: Column) -> Column:
    return F.startswith(token, F.lit("<!--")) & F.endswith(token, F.lit("-->")) & (F.length(token) >= 7)


def is_doctype(token: Column) -> Column:
    return (F.upper(F.substring(token, 1, 9)) == "<!DOCTYPE") & F.endswith(token, F.lit(">"))


def is_text(token: Column) -> Column:
    return ~F.startswith(token, F.lit("<")) | (F.length(token) == 1)


def token_kind(token: Column) -> Column:
    return (
        F.when(is_text(token), "text")
        .when(is_comment(token), "comment")
        .when(is_doctype(token), "doctype")
        .otherwise("tag")
    )


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, rf"\A</?+({_NAME})", 1))


def is_closing(token: Column) -> Column:
    return F.startswith(token, F.lit("</"))


def tag_tail(token: Column) -> Column:
    """What follows the tag name."""
    return F.regexp_replace(token, rf"\A</?+{_NAME}", "")


def is_self_closing(token: Column) -> Column:
    """A slash outside every attribute. Only open tags can be self-closing."""
    return ~is_closing(token) & F.contains(
        F.regexp_replace(tag_tail(token), ATTRIBUTE, ""), F.lit("/"))


def tag_attributes(token: Column) -> Column:
    """array<struct<name,value>> in order; the value is null for a bare name."""

    def parse(attr):
        has_value = F.regexp_extract(attr, _ATTRIBUTE_PARTS, 2) == "="
        value = F.concat(*[F.regexp_extract(attr, _ATTRIBUTE_PARTS, g) for g in (3, 4, 5)])
        return F.struct(
            F.regexp_extract(attr, _ATTRIBUTE_PARTS, 1).alias("name"),
            F.when(has_value, value).alias("value"),
        )

    return F.transform(
        F.regexp_extract_all(tag_tail(token), F.lit(ATTRIBUTE), F.lit(0)), parse)


def get_attr(attributes: Column, name: str) -> Column:
    """Value of the first attribute of that name, any case; null when absent or bare."""
    hits = F.filter(attributes, lambda a: F.lower(a["name"]) == name)
    return F.get(hits, 0)["value"]


def get_attr_decoded(attributes: Column, name: str) -> Column:
    return decode_entities(get_attr(attributes, name))

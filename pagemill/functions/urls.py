"""URL checks as Column expressions, following the WHATWG rules that matter for the check."""

from pyspark.sql import Column, functions as F

from pagemill.functions.text import let

_NUMBER = r"\A(?:0[xX][0-9A-Fa-f]*|[0-9]+)\z"
_FORBIDDEN = r"[\x00-\x20\x7f#/<>?@\[\\\]^|%:]"
_V6_LOOPBACK = r"\A\[(?:::|(?:0{1,4}:){1,7}|::(?:0{1,4}:){1,6}|(?:0{1,4}:){1,6}:)0{0,3}1\]\z"
_V6_LOCAL = r"\A\[f[cd][0-9a-f]{2}:"


def clean_url(url: Column) -> Column:
    """Without control characters and blanks at the ends, and without tabs and newlines."""
    return F.regexp_replace(url, r"\A[\x00-\x20]++|[\x00-\x20]++\z|[\t\n\r]", "")


def _labels(host: Column) -> Column:
    return F.split(F.regexp_replace(host, r"\.\z", ""), r"\.", -1)


def _number(part: Column) -> Column:
    """Decimal, octal (leading 0) or hexadecimal (leading 0x); null when malformed."""
    hexa = F.when(F.length(part) == 2, F.lit(0)).otherwise(
        F.conv(F.substring(part, 3, 16), 16, 10).try_cast("bigint"))
    return (
        F.when(part.rlike(r"\A0[xX][0-9A-Fa-f]{0,12}\z"), hexa)
        .when(part.rlike(r"\A0[0-7]{1,17}\z"), F.conv(part, 8, 10).try_cast("bigint"))
        .when(part.rlike(r"\A(?:0|[1-9][0-9]{0,17})\z"), part.try_cast("bigint")))


def ipv4_value(host: Column) -> Column:
    """The address as a 32-bit number; null when it is not a valid IPv4 address."""

    def combine(parts):
        count = F.size(parts)
        lead = F.slice(parts, 1, F.greatest(count - 1, F.lit(0)))
        last = F.element_at(parts, -1)
        weighted = F.aggregate(lead, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p)
        room = F.pow(F.lit(256), 5 - count).cast("bigint")
        valid = (count <= 4) & ~F.exists(lead, lambda p: p.isNull() | (p > 255)) & (last < room)
        return F.when(valid, weighted * room + last)

    return let(F.transform(_labels(host), _number), combine)


def _dotted(value: Column) -> Column:
    return F.concat_ws(".", *[
        (F.shiftright(value, s).bitwiseAND(F.lit(255))).cast("string") for s in (24, 16, 8, 0)])


def _parsed_host(named: Column) -> Column:
    """Null when invalid. A host whose last label is a number is an IPv4 address."""
    numeric = F.element_at(_labels(named), -1).rlike(_NUMBER)
    return (
        F.when(named.rlike(r"\A\[[0-9a-f:.]+\]\z"), named)
        .when((named == "") | named.rlike(_FORBIDDEN), F.lit(None))
        .when(numeric, let(ipv4_value(named), lambda v: F.when(v.isNotNull(), _dotted(v))))
        .otherwise(named))


def parse_url(url: Column) -> Column:
    """struct(scheme, host, port): scheme in lower case or empty, host null if invalid, port as text.

    The host is what a URL parser gives: lower case, numeric forms turned into dotted IPv4.
    Every step is computed once and read from the struct before it.
    """

    def from_authority(parts):
        return F.named_struct(
            F.lit("scheme"), parts["scheme"],
            F.lit("host"), let(F.lower(F.regexp_replace(parts["authority"], r":[^:\]]*+\z", "")), _parsed_host),
            F.lit("port"), F.regexp_extract(parts["authority"], r":([^:\]]*+)\z", 1))

    def split(cleaned):
        authority = F.regexp_extract(cleaned, r"\A[^:]*+:[/\\]*+([^/\\?#]*+)", 1)
        return F.named_struct(
            F.lit("scheme"), F.lower(F.regexp_extract(cleaned, r"\A([A-Za-z][A-Za-z0-9+.\-]*+):", 1)),
            F.lit("authority"), F.substring_index(authority, "@", -1))

    return let(let(clean_url(url), split), from_authority)


def host(url: Column) -> Column:
    return parse_url(url)["host"]


def is_private_host(hostname: Column) -> Column:
    """Loopback, link-local, private and this-network addresses, for a host() result.

    IPv6 forms are tested in brackets; names are never private, whatever they start with.
    """
    v4 = hostname.rlike(r"\A\d{1,3}(?:\.\d{1,3}){3}\z")
    octet = [F.regexp_extract(hostname, r"\A(\d+)\.(\d+)\.", i).try_cast("int") for i in (1, 2)]
    a, b = octet
    private_v4 = (
        a.isin(0, 10, 127)
        | ((a == 172) & b.between(16, 31))
        | ((a == 192) & (b == 168))
        | ((a == 169) & (b == 254)))
    return F.coalesce(
        F.when(v4, private_v4).otherwise(hostname.rlike(_V6_LOOPBACK) | hostname.rlike(_V6_LOCAL)),
        F.lit(False))


# Message texts by tool (fixed values).
_MESSAGES = {
    "fetch": ("URL is required and must be a non-empty string",
              '". Must be a valid URL (e.g. https://example.com)'),
    "raw": ("`http_url` is required and must be a non-empty string", '"'),
}


def validate_url(url: Column, tool: str = "fetch", allow_private: bool = False) -> Column:
    """Error text, or null when the URL may be fetched."""
    missing, invalid_tail = _MESSAGES[tool]

    def check(parsed):
        invalid = F.concat(F.lit('Invalid URL: "'), url, F.lit(invalid_tail))
        bad_port = ~parsed["port"].rlike(r"\A[0-9]{0,9}\z") | (
            F.coalesce(parsed["port"].try_cast("int"), F.lit(0)) > 65535)
        error = (
            F.when(parsed["scheme"] == "", invalid)
            .when(~parsed["scheme"].isin("http", "https"), F.concat(
                F.lit('Invalid protocol: "'), parsed["scheme"], F.lit(':". Only http: and https: are allowed')))
            .when(parsed["host"].isNull() | bad_port, invalid))
        if allow_private:
            return error
        return error.when(is_private_host(parsed["host"]), F.concat(
            F.lit('Access to internal/private address "'), parsed["host"], F.lit('" is blocked')))

    return F.when(F.coalesce(url, F.lit("")) == "", missing).otherwise(let(parse_url(url), check))

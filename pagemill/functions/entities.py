"""Character entity expressions and the entity dimension table."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.fixed import ENTITIES
from pagemill.functions.text import escape_marks, let, unescape_marks

# Named (1-10 letters or digits), decimal or hexadecimal reference, closed by a semicolon.
ENTITY = "&(?:[A-Za-z0-9]{1,10}|#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7});"
PIECE = ENTITY + "|[^&]++|&"


def entity_table(spark: SparkSession) -> DataFrame:
    """The known names, one row each: (name, value)."""
    return spark.createDataFrame(sorted(ENTITIES.items()), "name string, value string")


def _named() -> Column:
    pairs = "\ufdee".join(f"&{name};\ufdef{value}" for name, value in ENTITIES.items())
    return F.str_to_map(F.lit(pairs), F.lit("\ufdee"), F.lit("\ufdef"))


def _code_point(ref: Column) -> Column:
    digits = F.substring_index(F.substring(ref, 3, 10), ";", 1)
    return F.when(
        F.lower(digits).startswith("x"),
        F.conv(F.substring(digits, 2, 10), 16, 10).cast("bigint"),
    ).otherwise(digits.try_cast("bigint"))


def decode_piece(piece: Column) -> Column:
    """Decode one reference; an unknown one comes back unchanged."""
    code = _code_point(piece)
    usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    numeric = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.coalesce(
        F.when(F.substring(piece, 2, 1) == "#", numeric)
        .otherwise(F.try_element_at(_named(), piece)),
        piece,
    )


def entity_pieces(text: Column) -> Column:
    """Split into references, lone ampersands and the text between them."""
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def decode_entities(text: Column) -> Column:
    """Decode all character entities in one pass; unknown ones stay as they are."""
    decoded = F.array_join(
        F.transform(
            entity_pieces(text),
            lambda p: F.when(F.startswith(p, F.lit("&")) & (F.length(p) > 1), decode_piece(p)).otherwise(p),
        ),
        "",
    )
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def decode_escaped(text: Column) -> Column:
    """decode_entities on a text whose marks are escaped: those that references stand for are escaped too."""
    return F.when(F.contains(text, F.lit("&")), escape_marks(let(unescape_marks(text), decode_entities))).otherwise(text)

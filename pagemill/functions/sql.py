"""SQL names for the row-local functions: CREATE TEMPORARY FUNCTION with a SQL body."""

from pyspark.sql import SparkSession

from pagemill.functions.text import TRIM, WS, WS_INLINE

# Line ends are trimmed in two passes here; the SQL bodies are for short texts and ad-hoc use.
_BODIES = {
    "collapse_whitespace": f"regexp_replace(s, r'{WS}+', ' ')",
    "collapse_lines": (
        "regexp_replace(trim(BOTH '\\n' FROM regexp_replace(regexp_replace(regexp_replace("
        f"s, r'{WS_INLINE}+', ' '), r'(?m){TRIM}++(?=\\n|\\z)', ''), r'(?<=\\n|\\A){TRIM}++', '')), r'\\n{{3,}}', '\\n\\n')"),
    "is_text_content": (
        "coalesce(s, '') rlike r'(?i)\\A(?:text/|application/(?:json|xml|xhtml\\+xml|javascript)"
        "|application/x-www-form-urlencoded)'"),
}


def register(spark: SparkSession) -> list[str]:
    """Define the functions in the session's SQL catalog; returns their names."""
    for name, body in _BODIES.items():
        kind = "boolean" if name.startswith("is_") else "string"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s string) RETURNS {kind} RETURN {body}")
    return list(_BODIES)

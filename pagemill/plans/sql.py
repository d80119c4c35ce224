"""SQL text builders for the comparison queries; they state the rules a second, separate way."""

from pagemill.fixed import HTML_WHITESPACE, LINE_TRIM, STRIP_MODES  # noqa: F401


def _class(chars, negate=False):
    inner = "".join(f"\\x{{{ord(c):04x}}}" for c in chars)
    return f"[{'^' if negate else ''}{inner}]"


WS = _class(HTML_WHITESPACE)
WS_INLINE = _class(HTML_WHITESPACE.replace("\n", ""))
TRIM = _class(LINE_TRIM)
S = "chr(57344)"
S_RE = "\\x{e000}"
NOT_WS_S = _class(HTML_WHITESPACE + "", True)


def sub(x, pattern, to):
    return f"regexp_replace({x}, '{pattern}', {to}, 'g')"


def lines(x):
    """Collapse and trim each line, fold blank lines, none at the ends."""
    x = sub(x, WS_INLINE + "+", "' '")
    x = sub(x, f"(?m)^{TRIM}+|{TRIM}+$", "''")
    x = sub(x, "\\n{3,}", "chr(10)||chr(10)")
    return f"trim({x}, chr(10))"


def decode(x):
    """The references that occur in `pages`; unknown names stay."""
    for name, char in (("quot", '"'), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def no_scripts(x):
    return sub(x, "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", "''")


def no_declarations(x):
    return sub(x, "(?is)<!--.*?-->|<!doctype[^>]*>", "''")


def tags(x):
    x = sub(no_declarations(no_scripts(x)), "<[^>]*>", S)
    for _ in range(2):
        x = sub(x, f"({NOT_WS_S}){S_RE}+([^{S_RE}])", "'\\1 \\2'")
    return lines(decode(f"replace({x}, {S}, '')"))


def attributes(x):
    return sub(sub(x, "<([a-zA-Z0-9]+) [^>]*>", "'<\\1>'"), WS + "+", "' '")


def whitespace(x):
    return sub(x, WS + "+", "' '")


def visible(x):
    """Searchable text: outside tags, without script and style, whitespace one for one."""
    x = sub(no_declarations(no_scripts(x)), "<[^>]*>", "''")
    return sub(decode(x), WS, "' '")


def size(x):
    def scaled(unit, name):
        tenths = f"(({x} * 10 + {unit // 2}) // {unit})"
        return f"({tenths} // 10) || '.' || ({tenths} % 10) || '{name}'"

    return (f"case when {x} < 1024 then {x} || 'B' when {x} < 1048576 then {scaled(1024, 'KB')} "
            f"else {scaled(1048576, 'MB')} end")


RESPONSES = """(
  select 'pages' source, page_id id, url, regexp_replace(url, '^http://', 'https://') final_url, 200 status,
         'text/html; charset=utf-8' content_type, html raw_text, strlen(html) size from pages
  union all
  select 'documents', doc_id, 'https://docs.example.org/' || source || '/' || doc_id,
         'https://docs.example.org/' || source || '/' || doc_id, 200, 'text/plain', text, strlen(text) from documents
  union all
  select 'events', event_id, 'https://api.example.net/users/' || user_id || '/events/' || event_id,
         case when event_type = 'error' then 'http://192.168.0.' || (user_id % 256) || '/'
              else 'https://api.example.net/users/' || user_id || '/events/' || event_id end,
         case when event_type = 'error' then 503 else 200 end, 'application/json', props, strlen(props) from events
  union all
  select 'conversations', conv_id * 1000 + turn, 'https://chat.example.com/' || conv_id || '/' || turn,
         'https://chat.example.com/' || conv_id || '/' || turn,
         case when role = 'user' then 200 else 404 end, 'text/plain; charset=utf-8', text, strlen(text)
    from conversations
  union all
  select 'embeddings', vec_id, 'https://vec.example.com/' || vec_id, 'https://vec.example.com/' || vec_id, 200,
         'application/octet-stream', null, len(embedding) * 4 from embeddings
)"""

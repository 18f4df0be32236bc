"""Validation and parsing of configuration text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Name patterns and limits of labels, annotations and object names.
DNS_LABEL = "[a-z0-9]([a-z0-9\\-]*[a-z0-9])?"
SUBDOMAIN = f"{DNS_LABEL}(?:\\.{DNS_LABEL})*"
NAME = "[A-Za-z0-9]([A-Za-z0-9_.-]*[A-Za-z0-9])?"
NAME_PREFIX = "[A-Za-z0-9.-]+"
MAX_NAME = 63
MAX_SUBDOMAIN = 253
MAX_NAME_PREFIX = 30
MAX_ANNOTATION_BYTES = 262_144

# Words that mark a failed status line and an error line.
FAILED_STATUS = "Failed|Error|CrashLoopBackOff|OOMKilled|Evicted"
ERROR_LINE = "Exception|Error|Failed|FAILED"

# trimming removes every character up to the blank, not only blanks
BLANKS = "".join(chr(i) for i in range(33))


def full_match(text: Column, pattern: str) -> Column:
    """The whole text matches; unlike `^...$` this refuses a trailing line break."""
    return text.rlike(f"\\A(?:{pattern})\\z")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def to_long(text: Column) -> Column:
    """Whole number of a text, null for any other text. A failing cast is slow, so it is kept rare."""
    return (F.when(text.rlike("\\A[+-]?[0-9]{1,18}\\z"), text.cast("long"))
            .when(text.rlike("\\A[+-]?[0-9]{19,}\\z"), text.try_cast("long")))


def key_valid(key: Column) -> Column:
    """Name of at most 63 characters with an optional subdomain prefix before the first slash."""
    parts = F.split(key, "/", 2)
    name, prefix = F.element_at(parts, -1), F.get(parts, F.lit(0))
    name_ok = (F.length(name) <= MAX_NAME) & full_match(name, NAME)
    prefix_ok = (F.length(prefix) <= MAX_SUBDOMAIN) & full_match(prefix, SUBDOMAIN)
    return _sure(name_ok & ((F.size(parts) == 1) | prefix_ok))


def label_value_valid(value: Column) -> Column:
    return _sure((value == "") | ((F.length(value) <= MAX_NAME) & full_match(value, NAME)))


def annotation_value_valid(value: Column) -> Column:
    return _sure(F.octet_length(value) <= MAX_ANNOTATION_BYTES)


def name_valid(name: Column) -> Column:
    return _sure((F.length(name) <= MAX_SUBDOMAIN) & full_match(name, SUBDOMAIN))


def name_prefix_valid(prefix: Column) -> Column:
    return _sure((F.length(prefix) <= MAX_NAME_PREFIX) & full_match(prefix, NAME_PREFIX))


def path_source(path: Column) -> Column:
    """`http`, `file_uri` or `local` for a valid template path, `invalid` otherwise."""
    lower = F.lower(path)
    return (
        F.when(lower.startswith("http://") | lower.startswith("https://"), "http")
        .when(lower.startswith("file://"), "file_uri")
        .when((path != "") & ~path.contains("://"), "local")
        .otherwise("invalid")
    )


def master_url(url: Column, scheme: str) -> Column:
    """Struct (host, port) of `scheme://host:port`, null when malformed.

    Colons after the port are ignored and the host may be empty.
    """
    pattern = f"\\A{scheme}://([^:]*):([+-]?[0-9]+):*\\z"
    port = to_long(F.regexp_extract(url, pattern, 2))
    return F.when(port.between(0, 2**31 - 1), F.struct(
        F.regexp_extract(url, pattern, 1).alias("host"), port.cast("int").alias("port")))


def is_local_resource(uri: Column, default_scheme: str = "file") -> Column:
    """Whether a URI names a local file; a bare path follows the default file system."""
    head = F.regexp_extract(uri, "\\A([^/?#]*?):", 1)
    has_colon = uri.rlike("\\A[^/?#]*:")
    scheme = F.when(has_colon, F.lower(head)).otherwise(F.lit(default_scheme.lower()))
    broken = (
        uri.rlike("[\\x00-\\x20\"<>\\\\^`{|}]")
        | F.regexp_replace(uri, "%[0-9A-Fa-f]{2}", "").contains("%")
        | uri.rlike("#.*#")
        | (has_colon & ~uri.rlike("\\A[A-Za-z][A-Za-z0-9+.-]*:[^#]"))
    )
    return _sure(~broken & scheme.isin("file", "local"))


def kv_entries(text: Column, kind: str = "label") -> Column:
    """Array of (entry, key, value, ok) of a `k=v,k=v` list.

    Empty pieces are dropped before they are trimmed, so a blank piece is a bad entry. Keep the
    array in a column of its own when several results are made from it: it is then built once.
    """
    value_ok = {"label": label_value_valid, "annotation": annotation_value_valid}[kind]
    pieces = F.filter(F.split(strip(text), ","), lambda p: p != "")

    def entry(piece: Column) -> Column:
        parts = F.split(strip(piece), "=", 2)
        key, value = strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))
        return F.struct(strip(piece).alias("entry"), key.alias("key"), value.alias("value"),
                        (key_valid(key) & value_ok(value)).alias("ok"))

    return F.transform(pieces, entry)


def entries_valid(entries: Column) -> Column:
    return F.forall(entries, lambda e: e["ok"])


def entries_messages(entries: Column) -> Column:
    """A message for every bad entry."""
    bad = F.filter(entries, lambda e: ~e["ok"])
    return F.transform(bad, lambda e: F.concat(
        F.lit("Invalid label format: '"), e["entry"], F.lit("' (expected key=value)")))


def entries_map(entries: Column) -> Column:
    """Map of a valid list, null for a list with a bad entry; a repeated key keeps its last value."""
    pairs = F.transform(entries, lambda e: F.struct(e["key"], e["value"]))
    return F.when(entries_valid(entries), F.map_from_entries(pairs))


def conf_tokens(text: Column) -> Column:
    """Map of the `k=v` tokens of `--conf k=v --conf k=v`."""
    tokens = F.filter(F.split(text, "\\s+"), lambda x: x.contains("=") & ~x.startswith("-"))
    split = F.transform(tokens, lambda x: F.split(x, "=", 2))
    return F.map_from_entries(F.transform(split, lambda p: F.struct(F.get(p, F.lit(0)), F.get(p, F.lit(1)))))


# Duration units in microseconds.
DURATION_UNITS = {"us": 1, "ms": 1_000, "s": 1_000_000, "m": 60_000_000, "min": 60_000_000,
                  "h": 3_600_000_000, "d": 86_400_000_000}


def duration(text: Column, unit: Column) -> Column:
    """Whole `unit`s of a text such as `300s`, `5min` or `10` (in `unit`); null when malformed."""
    micros = F.create_map(*[F.lit(x) for name, n in DURATION_UNITS.items() for x in (name, n)])
    clean = F.lower(strip(text))
    # a text without a unit gets the default one appended
    full = F.regexp_replace(clean, "\\A(-?[0-9]+)\\z", F.concat(F.lit("$1"), unit))
    number = to_long(F.regexp_extract(full, "\\A(-?[0-9]+)[a-z]+\\z", 1))
    factor = F.try_element_at(micros, F.regexp_extract(full, "[a-z]+\\z", 0)).cast("long")
    return F.call_function("div", F.try_multiply(number, factor), F.try_element_at(micros, unit).cast("long"))


def error_lines(text: Column, limit: int = 10) -> Column:
    """First matching lines of an output text, as an array; stays inside the row."""
    return F.slice(F.filter(F.split(text, "\n"), lambda line: line.rlike(ERROR_LINE)), 1, limit)

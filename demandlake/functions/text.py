"""Text scalars: strip (P1), decode (S2), line split (S3), slugify."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.constants import DEFAULT_SLUG, SLUG_MAX_CHARS
from demandlake.functions.hof import let

# Python's str.isspace() set == Unicode White_Space plus the four ASCII
# information separators.  Java's \s is ASCII-only, hence the explicit class.
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# Boundaries of str.splitlines(): CRLF, LF, CR, VT, FF, FS, GS, RS, NEL, LS, PS.
LINE_BREAK = r"(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}])"
# Of these, all but LF.
OTHER_BREAK = r"[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
# Of these, the ones that a reader of plain text lines leaves in a line.
INNER_BREAK = r"[\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

BOM = "\ufeff"


def _cp1251_tables() -> tuple[str, str]:
    """High half of cp1251 as (latin-1 stand-ins, real characters).

    Derived from the codec itself; byte 0x98 is undefined and left out.
    """
    latin, real = [], []
    for byte in range(0x80, 0x100):
        try:
            char = bytes([byte]).decode("cp1251")
        except UnicodeDecodeError:
            continue
        latin.append(chr(byte))
        real.append(char)
    return "".join(latin), "".join(real)


CP1251_LATIN, CP1251_REAL = _cp1251_tables()
CP1251_UNDEFINED = "\u0098"
# Characters an export may hold if it is to be written as cp1251.
CP1251_SAFE = r"^[\x00-\x7f" + "".join(f"\\x{{{ord(c):x}}}" for c in CP1251_REAL) + r"]*$"


def strip(col: Column) -> Column:
    """Unicode strip, like ``str.strip()`` (U+FEFF is *not* whitespace).

    Two scans inwards from the ends; a regex anchored at the end would try every
    inner run of blanks, which takes quadratic time on one long run."""
    return F.btrim(col, F.lit(WS_CHARS))


def remove_whitespace(col: Column) -> Column:
    return F.regexp_replace(col, WS, "")


def fold_newlines(col: Column) -> Column:
    """Universal-newline read: CRLF and lone CR become LF."""
    return let(col, lambda t: F.when(F.contains(t, F.lit("\r")), F.regexp_replace(t, r"\r\n?", "\n")).otherwise(t))


def split_lines(col: Column) -> Column:
    """``str.splitlines()``: no trailing empty element, empty text -> []."""
    def split(t):
        # A line break at the end lies in the last two characters.
        body = F.concat(F.substring(t, F.lit(1), F.length(t) - 2), F.regexp_replace(F.right(t, F.lit(2)), LINE_BREAK + r"\z", ""))
        # Most texts break by LF alone, which is found without a pattern.
        lines = let(body, lambda b: F.when(b.rlike(OTHER_BREAK), F.split(b, LINE_BREAK, -1)).otherwise(F.split(b, "\n", -1)))
        return F.when(t == "", F.array().cast("array<string>")).otherwise(lines)

    return let(col, split)


def has_undefined_cp1251(content: Column) -> Column:
    """Whether the one byte occurs that cp1251 doesn't define."""
    return F.instr(F.decode(content, "ISO-8859-1"), CP1251_UNDEFINED) > 0


def from_cp1251(content: Column) -> Column:
    return F.translate(F.decode(content, "ISO-8859-1"), CP1251_LATIN, CP1251_REAL)


def decode_bytes(content: Column) -> tuple[Column, Column]:
    """Decode export bytes: UTF-8 (BOM dropped), else cp1251, else null.

    Returns ``(text, encoding)``; newlines are folded like a text-mode read.
    The cp1251 branch reads the bytes as ISO-8859-1 and maps the high half
    with ``translate``; both branches sit in one ``when`` so only the valid
    one is evaluated per row.
    """
    raw = content.cast("string")
    valid_utf8 = F.is_valid_utf8(raw)
    cp1251_ok = ~has_undefined_cp1251(content)
    unmarked = F.when(F.startswith(raw, F.lit(BOM)), F.regexp_replace(raw, "^" + BOM, "")).otherwise(raw)
    text = F.when(valid_utf8, unmarked).when(cp1251_ok, from_cp1251(content))
    encoding = F.when(valid_utf8, F.when(F.startswith(raw, F.lit(BOM)), "utf-8-sig").otherwise("utf-8")).when(
        cp1251_ok, "cp1251"
    )
    return fold_newlines(text), encoding


def encode_text(text: Column, encoding: Column | str) -> Column:
    """Render text as export bytes: 'utf-8', 'utf-8-sig' or 'cp1251'.

    cp1251 is produced by mapping to latin-1 stand-ins; callers only pass
    text matching ``CP1251_SAFE`` on that branch.
    """
    enc = F.lit(encoding) if isinstance(encoding, str) else encoding
    return (
        F.when(enc == "utf-8-sig", F.encode(F.concat(F.lit(BOM), text), "UTF-8"))
        .when(enc == "cp1251", F.encode(F.translate(text, CP1251_REAL, CP1251_LATIN), "ISO-8859-1"))
        .otherwise(F.encode(text, "UTF-8"))
    )


def slugify(col: Column) -> Column:
    """Runs outside [0-9A-Za-zА-Яа-я] -> '-', trim '-', lower, 64 chars, else 'query'."""
    compact = F.regexp_replace(strip(col), r"[^0-9A-Za-z\x{0410}-\x{044f}]+", "-")
    compact = F.lower(F.btrim(compact, F.lit("-")))
    short = F.substring(compact, 1, SLUG_MAX_CHARS)
    return F.coalesce(F.nullif(short, F.lit("")), F.lit(DEFAULT_SLUG))


def file_name(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-1))

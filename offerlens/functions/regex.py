"""Character classes shared by every text expression.

Java's ``\\w \\s \\d`` are ASCII by default and DuckDB's RE2 is ASCII-only, while
the reference relies on Python's Unicode ``re``.  Every pattern in this package
is therefore written with explicit classes that mean the same thing in Spark
(Java regex), DuckDB (RE2) and Python:

* ``WORD``  = Python's Unicode ``\\w``: letters, numbers, underscore.
* ``WS``    = Python's ``str.isspace`` set (what ``\\s`` and ``strip()`` use).
* ``DIGIT`` = ASCII digits; non-ASCII decimal digits are not treated as numbers.
"""

from __future__ import annotations

# Python's whitespace set, as regex class content (no brackets).
WS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WORD = r"\p{L}\p{N}_"
DIGIT = r"0-9"

S = f"[{WS}]"            # one whitespace char
NOT_WORD = f"[^{WORD}]"  # one non-word char
W = f"[{WORD}]"          # one word char

# Left / right word boundary as a consuming group: usable in both engines for
# existence tests (``rlike``/``regexp_matches``) where the consumed char does
# not matter.
LB = f"(?:^|{NOT_WORD})"
RB = f"(?:$|{NOT_WORD})"


def strip_pattern() -> str:
    """Leading or trailing whitespace, Python ``str.strip()`` semantics."""
    return f"^{S}+|{S}+$"


def boundary_free(pattern: str) -> str:
    """Rewrite ``\\b`` of a Python pattern into explicit, engine-neutral classes.

    A ``\\b`` next to a word character of the pattern becomes a consuming
    "start/end or non-word char" group; next to a non-word literal (``\\b\\.net``)
    it means "a word char is on the other side".  Only valid for existence
    tests, which is how skill patterns are used.
    """
    out = []
    i = 0
    n = len(pattern)
    while i < n:
        if pattern.startswith(r"\b", i):
            nxt = pattern[i + 2:i + 3]
            prev_is_start = not out
            if prev_is_start or out[-1] in ("(", "|"):
                # a leading boundary: look at the next pattern char
                if nxt == "\\" and pattern[i + 3:i + 4] in ".#/":
                    out.append(W)
                else:
                    out.append(LB)
            else:
                prev = out[-1]
                if prev.endswith("#") or prev.endswith("\\."):
                    out.append(W)
                else:
                    out.append(RB)
            i += 2
            continue
        if pattern[i] == "\\" and i + 1 < n:
            out.append(pattern[i:i + 2])
            i += 2
            continue
        out.append(pattern[i])
        i += 1
    return "".join(out)

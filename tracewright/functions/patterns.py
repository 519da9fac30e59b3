"""Redaction patterns.

Fixed values: the source patterns (Python ``re`` on str) and their
replacement tokens, in order. ``SOURCE_*`` are the originals (RE2 runs them
unchanged in the DuckDB oracles). ``JAVA_*`` are the same patterns with
Python's Unicode semantics spelled out for ``java.util.regex``:

* ``\\s`` -> the explicit Unicode whitespace class below (Java's is ASCII);
* ``\\d`` -> ``\\p{Nd}``;
* ``(?i)`` -> ``(?iu)`` (Unicode case folding);
* ``\\b`` next to a digit -> look-around on ``[\\p{L}\\p{N}_]``.
"""

from __future__ import annotations

# Source patterns, in rule order.
SOURCE_SECRET_PATTERNS = (
    r"""(?i)(?:api[_-]?key|secret|token|password|passwd|credential)\s*[:=]\s*['"]?[^\s'"]{8,}""",
    r"""(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9_]{36,}""",
    r"""AKIA[0-9A-Z]{16}""",
    r"""-----BEGIN (?:RSA |EC )?PRIVATE KEY-----""",
)
SOURCE_PII_PATTERNS = (
    (r"""[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}""", "[EMAIL_REDACTED]"),
    (r"""\b\d{3}[-.]?\d{3}[-.]?\d{4}\b""", "[PHONE_REDACTED]"),
)
SECRET_TOKEN = "[SECRET_REDACTED]"

# Python's str whitespace set (\s), exact over the BMP.
PY_SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PY_WORD = r"\p{L}\p{N}_"

JAVA_SECRET_PATTERNS = (
    r"""(?iu)(?:api[_-]?key|secret|token|password|passwd|credential)[""" + PY_SPACE + r"""]*[:=][""" + PY_SPACE
    + r"""]*['"]?[^""" + PY_SPACE + r"""'"]{8,}""",
    SOURCE_SECRET_PATTERNS[1],
    SOURCE_SECRET_PATTERNS[2],
    SOURCE_SECRET_PATTERNS[3],
)
JAVA_PII_PATTERNS = (
    SOURCE_PII_PATTERNS[0],
    (r"(?<![" + PY_WORD + r"])\p{Nd}{3}[-.]?\p{Nd}{3}[-.]?\p{Nd}{4}(?![" + PY_WORD + r"])", "[PHONE_REDACTED]"),
)

# Strict blob id pattern; Java's ``$`` also matches before a final newline,
# the source's does not, hence ``\z``.
JAVA_BLOB_ID_PATTERN = r"^sha256:[a-f0-9]+\z"
SOURCE_BLOB_ID_PATTERN = r"^sha256:[a-f0-9]+$"

# Literal requirements of each pattern (same order as the rule chain): a
# pattern can only match text containing one of these. Replacement tokens
# never introduce them, so checking the *original* text is exact; rows that
# fail the check skip that regex pass.
SECRET_REQUIRES = ((":", "="), ("_",), ("AKIA",), ("-----BEGIN ",))
PII_REQUIRES = (("@",), None)  # None: needs a decimal digit (checked with \p{Nd})

"""Declarative JSON field rules compiled to SQL expressions.

A rule table (``schemas.Field`` rows) is compiled into one SQL expression per
document that yields an ``array<struct<idx, field, code, message>>`` of
violations, evaluated as a single projection. Two dialects:

* ``SparkDialect``: the document is a VARIANT (``try_parse_json``), field kind
  from ``schema_of_variant`` (missing -> SQL NULL, explicit null -> VOID);
* ``DuckDialect``: the document is JSON text, kind from ``json_type``.

Type checks follow lax coercion: ints accept integral numbers, booleans and
integer strings; booleans accept 0/1 and the usual words; floats accept
numbers, numeric strings and booleans; strings accept only strings. A child
rule ``a.b`` is checked only when ``a`` is an object, as in nested models.
"""

from __future__ import annotations

from collections.abc import Sequence

from tracewright.schemas import ENUMS, Field

# Accepted boolean words (case-insensitive) and error texts.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "int_parsing_size": "Unable to parse input string as an integer, exceeded maximum size",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "dict_type": "Input should be a valid dictionary",
    "list_type": "Input should be a valid list",
    "string_too_short": "String should have at least {n} character",
    "too_short": "List should have at least 2 items after validation",
    "too_long": "List should have at most 2 items after validation",
}


# Fixed value: white space around numbers in strings.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def enum_message(domain: str) -> str:
    vals = [f"'{v}'" for v in ENUMS[domain]]
    return "Input should be " + (", ".join(vals[:-1]) + " or " + vals[-1] if len(vals) > 1 else vals[0])


class SparkDialect:
    def __init__(self, doc: str):
        self.doc = doc  # name of a VARIANT column

    def sub(self, path: str) -> str:
        return f"try_variant_get({self.doc}, {_sq('$.' + path)}, 'variant')"

    @staticmethod
    def col_name(path: str) -> str:
        return "_k_" + path.replace(".", "__")

    def kind_expr(self, path: str) -> str:
        # The first character of the JSON text tells the kind; one map lookup
        # keeps the (possibly large) to_json evaluated once per path and row.
        return (f"coalesce(element_at(map('', 'missing', '{{', 'object', '[', 'array', '\"', 'string', "
                f"'t', 'boolean', 'f', 'boolean', 'n', 'null'), "
                f"coalesce(substring(to_json({self.sub(path)}), 1, 1), '')), 'number')")

    def kind_at(self, path: str, i: int) -> str:
        return self.kind_expr(f"{path}[{i}]")

    def kind(self, path: str) -> str:
        """Reference to the precomputed kind column (see ``kind_columns``)."""
        return f"`{self.col_name(path)}`"

    def num(self, path: str) -> str:
        return self.number_of(f"{self.doc}, {_sq('$.' + path)}")

    @staticmethod
    def number_of(at: str) -> str:
        """The value at ``at`` (variant, path) as a double; strings may have white space around and digits grouped by underscores."""
        return (f"coalesce(try_variant_get({at}, 'double'), "
                f"try_cast(regexp_replace(try_variant_get({at}, 'string'), r'[_{SPACE}]', '') AS double))")

    def whole(self, path: str) -> str:
        """The value as a 64-bit integer, exact, a fraction cut off; NULL where it does not fit, or for a string that is no integer."""
        at = f"{self.doc}, {_sq('$.' + path)}"
        text = f"regexp_replace({self.text(path)}, r'[_{SPACE}]', '')"
        return (f"CASE {self.kind_expr(path)} WHEN 'number' THEN try_variant_get({at}, 'bigint') WHEN 'boolean' THEN CAST({self.boolean(path)} AS BIGINT) "
                f"WHEN 'string' THEN IF({self.regex(self.text(path), _INT_STR)}, try_cast(try_cast({text} AS decimal(38, 1)) AS bigint), NULL) END")

    @staticmethod
    def fraction(n: str) -> str:
        return f"({n} % 1)"

    def literal(self, path: str) -> str:
        return f"to_json({self.sub(path)})"

    def elem_literal(self) -> str:
        return "to_json(x)"

    def text(self, path: str) -> str:
        return f"try_variant_get({self.doc}, {_sq('$.' + path)}, 'string')"

    def boolean(self, path: str) -> str:
        return f"try_variant_get({self.doc}, {_sq('$.' + path)}, 'boolean')"

    def regex(self, x: str, pat: str) -> str:
        return f"({x} RLIKE r{_sq(pat)})"  # a raw literal: backslashes reach the pattern

    def array_len(self, path: str) -> str:
        return f"size(try_cast({self.sub(path)} AS array<variant>))"

    def bad_elements(self, path: str, item: str, when: str) -> str:
        """Violations of the elements (``x``, at 0-based position ``i``) where ``item`` is not NULL, if ``when`` holds."""
        return (f"CASE WHEN {when} THEN transform(try_cast({self.sub(path)} AS array<variant>), (x, i) -> {item}) "
                f"ELSE {self.array([])} END")

    def elem_kind(self) -> str:
        return ("coalesce(element_at(map('{', 'object', '[', 'array', '\"', 'string', 't', 'boolean', 'f', 'boolean', 'n', 'null'), "
                "substring(to_json(x), 1, 1)), 'number')")

    def elem_text(self) -> str:
        return "try_variant_get(x, '$', 'string')"

    def elem_num(self) -> str:
        return self.number_of("x, '$'")

    def elem_index(self) -> str:
        return "CAST(i AS STRING)"

    def flat(self, arrays: list[str]) -> str:
        return f"concat({', '.join(arrays)})" if len(arrays) > 1 else arrays[0]

    def struct(self, idx: int, field: str, code: str, message: str) -> str:
        return f"named_struct('idx', {idx}, 'field', {field}, 'code', {_sq(code)}, 'message', {_sq(message)})"

    def array(self, items: list[str]) -> str:
        if not items:
            return "array(CAST(NULL AS struct<idx: int, field: string, code: string, message: string>))"
        return f"array({', '.join(items)})"


class DuckDialect:
    def __init__(self, doc: str):
        self.doc = doc  # name of a JSON text column

    def kind(self, path: str) -> str:
        t = f"json_type({self.doc}, {_sq('$.' + path)})"
        return (f"(CASE WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'VARCHAR' THEN 'string' "
                f"WHEN {t} = 'BOOLEAN' THEN 'boolean' WHEN {t} = 'ARRAY' THEN 'array' WHEN {t} = 'OBJECT' THEN 'object' "
                f"ELSE 'number' END)")

    def kind_at(self, path: str, i: int) -> str:
        return self.kind(f"{path}[{i}]")

    def num(self, path: str) -> str:
        return f"TRY_CAST(regexp_replace(json_extract_string({self.doc}, {_sq('$.' + path)}), '[_{SPACE}]', '', 'g') AS DOUBLE)"

    @staticmethod
    def fraction(n: str) -> str:
        return f"(CASE WHEN isfinite({n}) THEN {n} - trunc({n}) ELSE 0 END)"

    def literal(self, path: str) -> str:
        return f"CAST(json_extract({self.doc}, {_sq('$.' + path)}) AS VARCHAR)"

    def elem_literal(self) -> str:
        return "CAST(x AS VARCHAR)"

    def text(self, path: str) -> str:
        return f"json_extract_string({self.doc}, {_sq('$.' + path)})"

    def boolean(self, path: str) -> str:
        return f"(json_extract_string({self.doc}, {_sq('$.' + path)}) = 'true')"

    def regex(self, x: str, pat: str) -> str:
        return f"regexp_matches({x}, {_sq(pat)})"

    def array_len(self, path: str) -> str:
        return f"json_array_length({self.doc}, {_sq('$.' + path)})"

    def bad_elements(self, path: str, item: str, when: str) -> str:
        lst = f"json_extract({self.doc}, {_sq('$.' + path + '[*]')})"
        return f"CASE WHEN {when} THEN list_transform({lst}, lambda x, i: {item}) ELSE {self.array([])} END"

    def elem_kind(self) -> str:
        return ("(CASE json_type(x) WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' "
                "WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END)")

    def elem_text(self) -> str:
        return "json_extract_string(x, '$')"

    def elem_num(self) -> str:
        return f"TRY_CAST(regexp_replace(json_extract_string(x, '$'), '[_{SPACE}]', '', 'g') AS DOUBLE)"

    def elem_index(self) -> str:
        return "CAST(i - 1 AS VARCHAR)"

    def flat(self, arrays: list[str]) -> str:
        return f"flatten([{', '.join(arrays)}])" if len(arrays) > 1 else arrays[0]

    def struct(self, idx: int, field: str, code: str, message: str) -> str:
        return f"{{'idx': {idx}, 'field': {field}, 'code': {_sq(code)}, 'message': {_sq(message)}}}"

    def array(self, items: list[str]) -> str:
        if not items:
            return "[CAST(NULL AS STRUCT(idx INTEGER, field VARCHAR, code VARCHAR, message VARCHAR))]"
        return f"[{', '.join(items)}]"


_DIGITS = "[0-9]+(_[0-9]+)*"
_AROUND = rf"[{SPACE}]*"
_INT_STR = rf"^{_AROUND}[+-]?{_DIGITS}(\.0+)?{_AROUND}$"
_FLOAT_STR = rf"^{_AROUND}[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS}|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])([eE][+-]?{_DIGITS})?{_AROUND}$"


def _int_checks(d, k: str, n: str, text: str, literal: str) -> list[tuple[str, str]]:
    """``literal`` is the JSON text of a number. Integers may have any size; a number written with a fraction or exponent must fit 64 bits."""
    return [(f"{k} = 'number' AND {d.fraction(n)} <> 0", "int_from_float"),
            (f"{k} = 'number' AND abs({n}) >= 9.223372036854775807E18 AND {d.regex(literal, '[.eE]')}", "int_parsing_size"),
            (f"{k} = 'string' AND NOT {d.regex(text, _INT_STR)}", "int_parsing"),
            (f"{k} NOT IN ('number', 'boolean', 'string')", "int_type")]


def _type_checks(d, f: Field, k: str) -> list[tuple[str, str]]:
    """Ordered (condition, code) pairs for a present, non-null value of kind
    ``k``; the first condition that holds is the violation."""
    p, kind = f.name, f.kind
    out: list[tuple[str, str]] = []
    if kind == "str":
        out.append((f"{k} <> 'string'", "string_type"))
        if f.min_length:
            out.append((f"length({d.text(p)}) < {f.min_length}", "string_too_short"))
    elif kind in ("int", "float"):
        n = d.num(p)
        s = d.text(p)
        if kind == "int":
            out += _int_checks(d, k, n, d.text(p), d.literal(p))
        else:
            out.append((f"{k} = 'string' AND NOT {d.regex(s, _FLOAT_STR)}", "float_parsing"))
            out.append((f"{k} NOT IN ('number', 'boolean', 'string')", "float_type"))
        if f.ge is not None:
            # the upper bound, where there is one, is the first to refuse a NaN
            below = f"{n} < {f.ge} OR isnan({n})" if f.le is None else f"{n} < {f.ge} AND NOT isnan({n})"
            out.append((f"{k} <> 'boolean' AND ({below})", "greater_than_equal"))
        if f.le is not None:
            out.append((f"{k} <> 'boolean' AND ({n} > {f.le} OR isnan({n}))", "less_than_equal"))
    elif kind == "bool":
        n = d.num(p)
        words = ", ".join(_sq(x) for x in TRUE_WORDS + FALSE_WORDS)
        out.append((f"{k} = 'number' AND {n} NOT IN (0, 1)", "bool_parsing"))
        out.append((f"{k} = 'string' AND lower(trim({d.text(p)})) NOT IN ({words})", "bool_parsing"))
        out.append((f"{k} NOT IN ('boolean', 'number', 'string')", "bool_type"))
    elif kind.startswith("enum:"):
        dom = ", ".join(_sq(x) for x in ENUMS[kind[5:]])
        out.append((f"{k} <> 'string' OR {d.text(p)} NOT IN ({dom})", "enum"))
    elif kind == "dict":
        out.append((f"{k} <> 'object'", "dict_type"))
    elif kind == "list_str" or kind.startswith("list_enum:"):
        out.append((f"{k} <> 'array'", "list_type"))
    elif kind == "int_pair":
        out.append((f"{k} <> 'array'", "list_type"))
        out.append((f"{d.array_len(p)} > 2", "too_long"))
        # a bad element is reported instead of a short list
        one_ok = " AND ".join(f"NOT ({c})" for c, _ in _int_checks(d, d.kind_at(p, 0), d.num(p + "[0]"), d.text(p + "[0]"), d.literal(p + "[0]")))
        out.append((f"{d.array_len(p)} = 0 OR ({d.array_len(p)} = 1 AND {one_ok})", "too_short"))
    else:
        raise ValueError(f"unknown kind {kind}")
    return out


def _fmt_bound(f: Field, v: float) -> str:
    return str(int(v)) if v == int(v) else repr(float(v))


def message_for(f: Field, code: str) -> str:
    if code == "enum":
        return enum_message(f.kind.split(":", 1)[1])
    if code == "greater_than_equal":
        return "Input should be greater than or equal to " + _fmt_bound(f, f.ge)
    if code == "less_than_equal":
        return "Input should be less than or equal to " + _fmt_bound(f, f.le)
    if code == "dict_type" and f.model:
        return f"{MESSAGES[code]} or instance of {f.model}"
    if code == "string_too_short":
        return MESSAGES[code].format(n=f.min_length or 1)
    return MESSAGES[code]


def _parents(path: str) -> list[str]:
    bits = path.split(".")
    return [".".join(bits[:i]) for i in range(1, len(bits))]


def kind_paths(fields: Sequence[Field]) -> list[str]:
    """Every path whose kind a rule set reads (fields and their parents)."""
    out: list[str] = []
    for f in fields:
        for p in _parents(f.name) + [f.name]:
            if p not in out:
                out.append(p)
    return out


def _null_code(f: Field) -> str:
    return {"str": "string_type", "int": "int_type", "bool": "bool_type", "float": "float_type",
            "dict": "dict_type", "list_str": "list_type", "int_pair": "list_type"}.get(
        f.kind, "enum" if f.kind.startswith("enum:") else "list_type")


def _element_checks(d, f: Field) -> tuple[list[tuple[str, str]], Field] | None:
    """Ordered (condition, code) pairs over an element of list field ``f``, and the field that its messages speak of; None
    if elements are not checked."""
    k = d.elem_kind()
    if f.kind == "list_str":
        return [(f"{k} <> 'string'", "string_type")], f
    if f.kind.startswith("list_enum:"):
        dom = ", ".join(_sq(x) for x in ENUMS[f.kind.split(":", 1)[1]])
        return [(f"{k} <> 'string' OR {d.elem_text()} NOT IN ({dom})", "enum")], f
    if f.kind == "int_pair":
        return _int_checks(d, k, d.elem_num(), d.elem_text(), d.elem_literal()), Field(f.name, "int")
    return None


def _element_item(d, f: Field, idx: int, prefix_sql: str) -> str | None:
    """CASE over an element of list field ``f``: its violation or NULL. None if elements are not checked."""
    found = _element_checks(d, f)
    if found is None:
        return None
    field = f"concat({prefix_sql}, {_sq(f.name + '.')}, {d.elem_index()})"
    whens = " ".join(f"WHEN {cond} THEN {d.struct(idx, field, code, message_for(found[1], code))}" for cond, code in found[0])
    return f"CASE {whens} END"


def compile_any(d: SparkDialect, fields: Sequence[Field]) -> str:
    """SQL expression: whether any rule is violated. The conditions of ``compile_rules`` without its structs and texts, for
    plans that only ask whether a document passes."""
    out = []
    for f in fields:
        k = d.kind(f.name)
        guard = [f"{d.kind(p)} = 'object'" for p in _parents(f.name)]
        checks = " ".join(f"WHEN {cond} THEN true" for cond, _ in _type_checks(d, f, k))
        own = f"CASE {k} WHEN 'missing' THEN {str(f.required).lower()} WHEN 'null' THEN {str(not f.nullable).lower()} ELSE CASE {checks} ELSE false END END"
        out.append(" AND ".join([*guard, own]))
        found = _element_checks(d, f)
        if found is not None:
            bad = " OR ".join(f"coalesce({cond}, false)" for cond, _ in found[0])
            size = [f"{d.array_len(f.name)} <= 2"] if f.kind == "int_pair" else []
            out.append(" AND ".join([*guard, f"{k} = 'array'", *size, f"exists(try_cast({d.sub(f.name)} AS array<variant>), x -> {bad})"]))
    return " OR ".join(f"coalesce({x}, false)" for x in out) if out else "false"


def compile_rules(d, fields: Sequence[Field], prefix_sql: str = "''") -> str:
    """SQL expression: array with one slot per rule, holding a violation
    struct (idx, field, code, message) or NULL, and after these one slot per
    element of each checked list. Callers explode it and keep the non-null
    slots. Only literals, CASE and column references: no lambdas except for
    list elements."""
    items, lists = [], []
    for idx, f in enumerate(fields):
        k = d.kind(f.name)
        field_sql = f"concat({prefix_sql}, {_sq(f.name)})"
        guard = " AND ".join(f"{d.kind(p)} = 'object'" for p in _parents(f.name))
        whens = []
        if guard:
            whens.append(f"WHEN NOT ({guard}) THEN NULL")
        whens.append(f"WHEN {k} = 'missing' THEN " +
                     (d.struct(idx, field_sql, "missing", message_for(f, "missing")) if f.required else "NULL"))
        whens.append(f"WHEN {k} = 'null' THEN " +
                     ("NULL" if f.nullable else d.struct(idx, field_sql, _null_code(f), message_for(f, _null_code(f)))))
        for cond, code in _type_checks(d, f, k):
            whens.append(f"WHEN {cond} THEN {d.struct(idx, field_sql, code, message_for(f, code))}")
        items.append(f"CASE {' '.join(whens)} END")
        item = _element_item(d, f, idx, prefix_sql)
        if item is not None:
            conds = ([guard] if guard else []) + [f"{k} = 'array'"]
            if f.kind == "int_pair":
                conds.append(f"{d.array_len(f.name)} <= 2")
            lists.append(d.bad_elements(f.name, item, " AND ".join(conds)))
    return d.flat([d.array(items), *lists])

"""DuckDB SQL for generated tables: the declared specs rendered a second time, in another dialect.

Nothing here is used by the library. The value stream is re-derived from the
published XXH64 steps with exact integer arithmetic, so equal results mean that
the Spark expressions compute what the declarations say.
"""

from __future__ import annotations

import string
import struct
from dataclasses import replace
from functools import singledispatch

from finloom.functions.streams import salt
from finloom.functions.templates import template_runs
from finloom.functions.values import amount_units, clamp_rate, weight_slots
from finloom.plans import specs as s
from finloom.sources.domains import read_domains

MASK = 2**64
P1, P2, P3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
P4, P5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
DEFAULT_OPTIONS = s.Options()


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def wide(number: int) -> str:
    return f"{number}::UHUGEINT"


def stream_ctes(ids_sql: str, salts: list[int]) -> str:
    """CTEs ending in ``drawn(id, v)``: v[k] is the k-th stream of the row."""
    import xxhash  # only whoever asks for SQL needs it

    seeds = ", ".join(
        str((xxhash.xxh64_intdigest(struct.pack("<q", value), seed=42) + P5 + 8) % MASK) for value in salts)
    low = f"& {wide(MASK - 1)}"
    return f"""ids AS ({ids_sql}),
x0 AS (SELECT id, (id::UHUGEINT * {wide(P2)}) {low} AS x FROM ids),
x1 AS (SELECT id, ((((x << 31) {low}) + (x >> 33)) * {wide(P1)}) {low} AS x FROM x0),
h1 AS (SELECT id, list_transform([{seeds}]::UHUGEINT[], lambda h: xor(h, x)) AS v FROM x1),
h2 AS (SELECT id, list_transform(v, lambda h:
  ((((((h << 27) {low}) + (h >> 37)) * {wide(P1)}) {low}) + {wide(P4)}) {low}) AS v FROM h1),
h3 AS (SELECT id, list_transform(v, lambda h: (xor(h, h >> 33) * {wide(P2)}) {low}) AS v FROM h2),
h4 AS (SELECT id, list_transform(v, lambda h: (xor(h, h >> 29) * {wide(P3)}) {low}) AS v FROM h3),
drawn AS (SELECT id, list_transform(v, lambda h: (xor(h, h >> 32) >> 1)::BIGINT) AS v FROM h4)"""


class Rendering:
    """Collects the streams a table needs while its columns are rendered."""

    def __init__(self, spec: s.TableSpec, rows: str, sizes: dict[str, str], seed: int = s.DEFAULT_SEED,
                 options: s.Options = DEFAULT_OPTIONS, columns: list[str] | None = None, domains=None):
        self.wanted = columns or [name for name, _ in spec.fields()]
        self.domains = read_domains(domains)
        self.owners = {name: replaced(column, self.domains.get(name)) for column in spec.columns
                       for name, _ in column.fields()}
        self.spec, self.rows, self.sizes, self.seed, self.options = spec, rows, sizes, seed, options
        self.streams: dict[str, int] = {}
        self.made: dict[str, str] = {}

    def draw(self, name: str) -> str:
        place = self.streams.setdefault(name, len(self.streams) + 1)
        return f"v[{place}]"

    def size(self, table: str) -> str:
        return self.rows if table == self.spec.name else self.sizes[table]

    def column(self, name: str) -> str:
        """SQL of one column, rendered when first asked for."""
        if name not in self.made:
            column = self.owners[name]
            made = sql_of(column, self)
            threshold = round(clamp_rate(column.null_rate) * 1_000_000)
            if threshold > 0:
                shared = column.path if self.options.ragged and column.path else column.name
                gate = self.draw(f"{shared}#null")
                made = {key: f"CASE WHEN {gate} % 1000000 >= {threshold} THEN {sql} END" for key, sql in made.items()}
            self.made.update(made)
        return self.made[name]

    def render(self) -> str:
        return ",\n  ".join(f'{self.column(name)} AS "{name}"' for name in self.wanted)

    def salts(self) -> list[int]:
        return [salt(self.seed, self.spec.name, name) for name in self.streams] or [0]


def replaced(column: s.Spec, own) -> s.Spec:
    """The declaration that a domain stands for."""
    if own is None:
        return column
    if isinstance(column, s.Pick):
        return replace(column, values=own.values, weights=own.weights, draws_as=own.draws_as or column.draws_as)
    if isinstance(column, (s.Cycle, s.CodeOf)):
        return replace(column, values=own.values)
    if isinstance(column, s.Day):
        return replace(column, begin=own.low, end=own.high)
    if isinstance(column, s.Constant):
        return replace(column, constant=own.values[0])
    return column if isinstance(column, s.Period) else replace(column, low=own.low, high=own.high)


def table_ctes(ids_sql: str, rendering: Rendering, name: str = "built") -> str:
    projection = rendering.render()
    return f"{stream_ctes(ids_sql, rendering.salts())},\n{name} AS (SELECT {projection}\nFROM drawn)"


def table_sql(ids_sql: str, rendering: Rendering) -> str:
    return f"WITH {table_ctes(ids_sql, rendering)}\nSELECT * FROM built"


def ref_sql(draw: str, size: str) -> str:
    return f"({draw} % greatest(1, {size}) + 1)"


def width_sql(pad: int, size: str) -> str:
    return f"greatest({pad}, length(({size})::VARCHAR))::INT"


def key_sql(number: str, prefix: str, pad: int, size: str) -> str:
    return f"('{prefix}_' || lpad(({number})::VARCHAR, {width_sql(pad, size)}, '0'))"


def list_sql(values, position: str, kind: str) -> str:
    items = ", ".join(quoted(x) if isinstance(x, str) else str(x) for x in values)
    cast = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}[kind]
    return f"([{items}][({position}) + 1])::{cast}"


def text_sql(draw_for_run, template: str) -> str:
    pieces, marked = [], 0
    for mark, body in template_runs(template):
        if mark == "":
            pieces.append(quoted(body))
            continue
        draw, count = draw_for_run(marked), len(body)
        marked += 1
        if mark == "d":
            pieces.append(f"lpad(({draw} % {10**count})::VARCHAR, {count}, '0')")
        else:
            alphabet = string.ascii_uppercase if mark == "r" else string.ascii_lowercase
            places = ", ".join(str(26**k) for k in reversed(range(count)))
            pieces.append(f"array_to_string(list_transform([{places}]::BIGINT[], "
                          f"lambda d: substr('{alphabet}', ({draw} // d % 26 + 1)::INT, 1)), '')")
    return "(" + " || ".join(pieces) + ")"


@singledispatch
def sql_of(column, r: Rendering) -> dict[str, str]:
    raise TypeError(f"no rendering for {type(column).__name__}")


@sql_of.register
def _(c: s.DenseKey, r):
    return {c.name: f"id::{'INTEGER' if c.type == 'int' else 'BIGINT'}"}


@sql_of.register
def _(c: s.TextKey, r):
    size = f"greatest({r.rows}, {r.sizes[c.domain]})" if c.domain and c.domain in r.sizes else r.rows
    made = {c.counter: "id::BIGINT"} if c.counter else {}
    return made | {c.name: key_sql("id", c.prefix, c.pad, size)}


@sql_of.register
def _(c: s.Ref, r):
    return {c.name: f"{ref_sql(r.draw(c.name), r.size(c.table))}::{'INTEGER' if c.type == 'int' else 'BIGINT'}"}


@sql_of.register
def _(c: s.TextRef, r):
    number = ref_sql(r.draw(c.stream_name(r.options)), r.size(c.table))
    made = {c.counter: f"{number}::BIGINT"} if c.counter else {}
    return made | {c.name: key_sql(number, c.prefix, c.pad, r.size(c.table))}


@sql_of.register
def _(c: s.FreeCode, r):
    if r.options.link_codes:
        size = r.size(c.table)
        return {c.name: key_sql(ref_sql(r.draw(c.name), size), c.prefix, c.pad, size)}
    digits = r.draw(f"{c.name}#0")
    return {c.name: f"('{c.prefix}_' || lpad(({digits} % {10**c.pad})::VARCHAR, {c.pad}, '0'))"}


@sql_of.register
def _(c: s.Pick, r):
    draw = r.draw(c.stream_name(r.options))
    if c.weights is None:
        return {c.name: list_sql(c.values, f"{draw} % {len(c.values)}", c.type)}
    slots = weight_slots(c.weights)
    kind = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}[c.type]
    branches, bound = [], 0
    for value, slot in zip(c.values, slots):
        bound += slot
        literal = quoted(value) if isinstance(value, str) else str(value)
        branches.append(f"WHEN {draw} % {sum(slots)} < {bound} THEN {literal}")
    return {c.name: f"(CASE {' '.join(branches)} END)::{kind}"}


@sql_of.register
def _(c: s.Cycle, r):
    return {c.name: list_sql(c.values, f"(id - 1) // {c.every} % {len(c.values)}", c.type)}


@sql_of.register
def _(c: s.CodeOf, r):
    if r.options.independent_codes:
        return {c.name: list_sql(c.values, f"{r.draw(c.name)} % {len(c.values)}", "string")}
    number = ref_sql(r.draw(c.key), r.size(c.table)) if c.table else "id"
    return {c.name: list_sql(c.values, f"({number} - 1) % {len(c.values)}", "string")}


@sql_of.register
def _(c: s.Template, r):
    return {c.name: text_sql(lambda run: r.draw(f"{c.name}#{run}"), c.template)}


@sql_of.register
def _(c: s.Amount, r):
    scale, first, units = amount_units(c.low, c.high, c.scale)
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return {c.name: f"(({r.draw(c.name)} % {units} + ({first}))::DECIMAL(18,0) * {unit})"
                    f"::DECIMAL({c.precision},{c.scale})"}


@sql_of.register
def _(c: s.Whole, r):
    kind = "INTEGER" if c.type == "int" else "BIGINT"
    return {c.name: f"({r.draw(c.name)} % {c.high - c.low + 1} + {c.low})::{kind}"}


@sql_of.register
def _(c: s.Real, r):
    return {c.name: f"({float(c.low)}::DOUBLE + ({r.draw(c.name)} % {1 << 24})::DOUBLE / {float(1 << 24)}::DOUBLE"
                    f" * {float(c.high) - float(c.low)}::DOUBLE)::FLOAT"}


@sql_of.register
def _(c: s.Day, r):
    return {c.name: f"(DATE '{c.begin}' + ({r.draw(c.name)} % (DATE '{c.end}' - DATE '{c.begin}' + 1))::INT)"}


@sql_of.register
def _(c: s.Period, r):
    place, own = f"({r.draw(c.name)} % {r.size(c.table)})", r.domains.get(c.name)
    if own:
        first, last = (f"DATE '{n // 100}-{n % 100:02d}-01'" for n in (own.low, own.high))
        month = f"({first} + to_months(({r.draw(c.name)} % (date_diff('month', {first}, {last}) + 1))::INT))"
        return {c.name: f"(year({month}) * 100 + month({month}))::INTEGER"}
    start = r.options.start_year if c.start_year is None else c.start_year
    return {c.name: f"(({start} + {place} // 12) * 100 + {place} % 12 + 1)::INTEGER"}


@sql_of.register
def _(c: s.YearOf, r):
    return {c.name: f"({r.column(c.period)} // 100)::INTEGER"}


@sql_of.register
def _(c: s.NumberOf, r):
    return {c.name: f"lpad(({r.draw(c.name)} % least(99, greatest(1, {r.size(c.table)})) + 1)::VARCHAR, 2, '0')"}


@sql_of.register
def _(c: s.PaddedId, r):
    number = r.column(c.key) if c.key else "id"
    return {c.name: f"lpad(({number})::VARCHAR, {width_sql(c.pad, r.size(c.table))}, '0')"}


@sql_of.register
def _(c: s.Label, r):
    return {c.name: "(" + " || ".join(r.column(body) if is_column else quoted(body)
                                      for body, is_column in c.pieces()) + ")"}


@sql_of.register
def _(c: s.Constant, r):
    return {c.name: f"{quoted(c.constant)}::{'DATE' if c.type == 'date' else 'VARCHAR'}"}

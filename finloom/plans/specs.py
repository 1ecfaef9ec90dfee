"""Column specs: one small record per column, turned into a Catalyst Column over the row id.

A table is a tuple of these, so the same declaration gives the projection
(``TableSpec.project``) and the contract (``TableSpec.fields``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finloom import functions as fn
from finloom.functions import fiscal, streams
from finloom.functions.values import clamp_rate, weight_slots
from finloom.sources.domains import Domain

DEFAULT_SEED = 42


@dataclass(frozen=True)
class Options:
    """Choices where one table can be built in more than one sound way.

    independent_codes: draw a code apart from its id or partner column.
    ragged: one depth per row, so a NULL level has only NULL levels below it.
    link_codes: make free-standing codes such as ``PC_123456`` real references.
    strict_pads: refuse a domain that outgrows its pad instead of widening it.
    start_year, years: the span of the fiscal calendar.
    """

    independent_codes: bool = False
    ragged: bool = False
    link_codes: bool = False
    strict_pads: bool = False
    start_year: int = fiscal.START_YEAR
    years: int = fiscal.YEARS


@dataclass
class Build:
    """What a spec may read while its Column is made."""

    table: str
    rows: int
    row_id: str
    sizes: Mapping[str, int] = field(default_factory=dict)
    seed: int = DEFAULT_SEED
    domains: Mapping[str, Domain] = field(default_factory=dict)
    options: Options = Options()
    owners: Mapping[str, Spec] = field(default_factory=dict)
    made: dict[str, Column] = field(default_factory=dict)

    @property
    def id(self) -> Column:
        return F.expr(self.row_id)

    def column(self, name: str) -> Column:
        """The Column of that name; only columns somebody asks for are ever made."""
        if name not in self.made:
            self.made.update(self.owners[name].make(self))
        return self.made[name]

    def draw(self, name: str) -> str:
        return streams.stream(self.row_id, self.seed, self.table, name)

    def size_of(self, table: str) -> int:
        if table == self.table:
            return self.rows
        if table not in self.sizes:
            raise KeyError(f"{self.table} refers to {table}: declare how many rows it has")
        return self.sizes[table]

    def width(self, pad: int, rows: int) -> int:
        return fn.pad_width(pad, rows, self.options.strict_pads)

    def domain(self, name: str) -> Domain | None:
        return self.domains.get(f"{self.table}.{name}") or self.domains.get(name)


@dataclass(frozen=True)
class Spec:
    name: str
    type: str = field(default="string", kw_only=True)
    null_rate: float = field(default=0.0, kw_only=True)
    path: str | None = field(default=None, kw_only=True)

    def fields(self) -> list[tuple[str, str]]:
        return [(self.name, self.type)]

    def value(self, b: Build) -> Column:
        raise NotImplementedError

    def make(self, b: Build) -> dict[str, Column]:
        rate = clamp_rate(self.null_rate)
        value = self.value(b)
        if rate > 0:
            value = streams.null_out(value, b.draw(self.null_stream(b.options)), rate)
        return {self.name: value}

    takes = None  # kind of domain that may replace the values: "list", "range" or none

    def refusal(self, own: Domain) -> str | None:
        """Why this domain can't replace the column's values, if it can't."""
        if self.takes is None:
            return "its values follow from other columns or rows"
        if own.is_range != (self.takes == "range"):
            return f"it takes a {self.takes}"
        if not own.is_range and not own.values:
            return "the list is empty"
        return None

    def null_stream(self, options: Options) -> str:
        shared = self.path if options.ragged and self.path else self.name
        return f"{shared}#null"


@dataclass(frozen=True)
class DenseKey(Spec):
    type: str = field(default="bigint", kw_only=True)

    def value(self, b):
        return fn.int_key(b.id, b.rows) if self.type == "int" else fn.dense_key(b.id)


@dataclass(frozen=True)
class TextKey(Spec):
    """Prefixed key; ``domain`` names the dimension whose size sets the pad of a partial copy."""

    prefix: str
    pad: int
    counter: str | None = None
    domain: str | None = None

    def fields(self):
        helper = [(self.counter, "bigint")] if self.counter else []
        return helper + [(self.name, "string")]

    def make(self, b):
        rows = max(b.rows, b.size_of(self.domain)) if self.domain else b.rows
        made = {self.counter: fn.dense_key(b.id)} if self.counter else {}
        return made | {self.name: fn.text_key(b.id, self.prefix, b.width(self.pad, rows))}


@dataclass(frozen=True)
class Ref(Spec):
    """Id of a parent row; ``declared=False`` keeps it out of the contract's relations."""

    table: str
    declared: bool = True
    type: str = field(default="bigint", kw_only=True)

    def value(self, b):
        return fn.ref(b.draw(self.name), b.size_of(self.table)).cast(self.type)


@dataclass(frozen=True)
class TextRef(Spec):
    """Text key of a parent row. ``draws_as`` names the id column it agrees with."""

    table: str
    prefix: str
    pad: int
    counter: str | None = None
    draws_as: str | None = None
    declared: bool = True

    def fields(self):
        helper = [(self.counter, "bigint")] if self.counter else []
        return helper + [(self.name, "string")]

    def stream_name(self, options: Options) -> str:
        return self.name if options.independent_codes or not self.draws_as else self.draws_as

    def make(self, b):
        rows = b.size_of(self.table)
        number = fn.ref(b.draw(self.stream_name(b.options)), rows)
        made = {self.counter: number} if self.counter else {}
        return made | {self.name: fn.text_key(number, self.prefix, b.width(self.pad, rows))}


@dataclass(frozen=True)
class FreeCode(Spec):
    """Text that looks like a parent key but is drawn freely, unless ``link_codes`` is set."""

    prefix: str
    pad: int
    table: str

    def value(self, b):
        if b.options.link_codes:
            rows = b.size_of(self.table)
            return fn.text_key(fn.ref(b.draw(self.name), rows), self.prefix, b.width(self.pad, rows))
        return fn.text(lambda run: b.draw(f"{self.name}#{run}"), _literal(self.prefix) + "_" + "d" * self.pad)


def _literal(prefix: str) -> str:
    return "".join("\\" + ch if ch in "rad\\" else ch for ch in prefix)


@dataclass(frozen=True)
class Pick(Spec):
    """Category, uniform or weighted. ``draws_as`` pairs it with another column of equal weights."""

    values: Sequence
    weights: Sequence[int] | None = None
    draws_as: str | None = None
    takes = "list"

    def stream_name(self, options: Options) -> str:
        return self.name if options.independent_codes or not self.draws_as else self.draws_as

    def choices(self, b: Build) -> tuple[Sequence, Sequence[int] | None]:
        """Values and weights after any replacement."""
        own = b.domain(self.name)
        if not own or not own.values:
            return self.values, self.weights
        convert = int if self.type in ("int", "bigint") else str
        return [convert(v) for v in own.values], own.weights

    def value(self, b):
        values, weights = self.choices(b)
        own = b.domain(self.name)
        if own and own.draws_as:
            return fn.pick(b.draw(own.draws_as), values, weights, self.type)
        name = self.stream_name(b.options)
        if name != self.name and not self._pairs_with(b.owners[name].choices(b), (values, weights)):
            name = self.name
        return fn.pick(b.draw(name), values, weights, self.type)

    @staticmethod
    def _pairs_with(partner: tuple, own: tuple) -> bool:
        """Two lists name the same members only while they are equally long and equally weighted."""
        slots = [weight_slots(weights) if weights else None for _, weights in (partner, own)]
        return len(partner[0]) == len(own[0]) and slots[0] == slots[1]


@dataclass(frozen=True)
class Cycle(Spec):
    """Values in order by id, each repeated ``every`` times before the next."""

    values: Sequence
    every: int = 1
    takes = "list"

    def refusal(self, own):
        return super().refusal(own) or ("its values come in order, without weights" if own.weights else None)

    def members(self, b):
        own = b.domain(self.name)
        return [int(v) if self.type in ("int", "bigint") else str(v) for v in own.values] if own else self.values

    def value(self, b):
        step = b.row_id if self.every == 1 else f"({b.row_id} - 1) div {self.every} + 1"
        return fn.cycle(step, self.members(b), self.type)


@dataclass(frozen=True)
class CodeOf(Spec):
    """Code belonging to an id: the row's own, or one it refers to in ``table``.

    Both sides then name the same member; independent draws on request.
    """

    values: Sequence
    key: str
    table: str | None = None
    takes = "list"

    def refusal(self, own):
        return super().refusal(own) or ("its values follow its ids, without weights" if own.weights else None)

    def value(self, b):
        own = b.domain(self.name)
        values = [str(v) for v in own.values] if own else self.values
        if b.options.independent_codes:
            return fn.pick(b.draw(own.draws_as if own and own.draws_as else self.name), values)
        number = f"{b.draw(self.key)} % {b.size_of(self.table)}L + 1L" if self.table else b.row_id
        return fn.cycle(number, values)


@dataclass(frozen=True)
class Template(Spec):
    template: str

    def value(self, b):
        return fn.text(lambda run: b.draw(f"{self.name}#{run}"), self.template)


@dataclass(frozen=True)
class Amount(Spec):
    low: object = -1_000_000
    high: object = 5_000_000
    precision: int = 28
    scale: int = 5
    takes = "range"

    def fields(self):
        return [(self.name, f"decimal({self.precision},{self.scale})")]

    def bounds(self, b):
        own = b.domain(self.name)
        return (own.low, own.high) if own else (self.low, self.high)

    def value(self, b):
        return fn.amount(b.draw(self.name), *self.bounds(b), self.precision, self.scale)


@dataclass(frozen=True)
class Whole(Spec):
    low: int
    high: int
    type: str = field(default="int", kw_only=True)
    takes = "range"

    def value(self, b):
        own = b.domain(self.name)
        low, high = (own.low, own.high) if own else (self.low, self.high)
        return fn.whole(b.draw(self.name), int(low), int(high), self.type)


@dataclass(frozen=True)
class Real(Spec):
    low: float
    high: float
    type: str = field(default="float", kw_only=True)
    takes = "range"

    def value(self, b):
        own = b.domain(self.name)
        low, high = (float(own.low), float(own.high)) if own else (self.low, self.high)
        return fn.real(b.draw(self.name), low, high)


@dataclass(frozen=True)
class Day(Spec):
    begin: str = "2015-01-01"
    end: str = "2025-12-31"
    type: str = field(default="date", kw_only=True)
    takes = "range"

    def value(self, b):
        own = b.domain(self.name)
        begin, end = (str(own.low), str(own.high)) if own else (self.begin, self.end)  # YAML reads dates as dates
        return fn.day(b.draw(self.name), begin, end)


@dataclass(frozen=True)
class Period(Spec):
    """Fiscal period out of the calendar table's own list."""

    table: str = "calendar_fiscal_period_v"
    declared: bool = True
    start_year: int | None = None  # of its own calendar, if that is not the dataset's
    type: str = field(default="int", kw_only=True)
    takes = "range"

    def value(self, b):
        start = b.options.start_year if self.start_year is None else self.start_year
        own = b.domain(self.name)
        if own:
            return fn.period_between(b.draw(self.name), int(own.low), int(own.high), b.size_of(self.table), start,
                                     b.options.years)
        return fn.fiscal_period(b.draw(self.name), b.size_of(self.table), start, b.options.years)


@dataclass(frozen=True)
class YearOf(Spec):
    period: str
    type: str = field(default="int", kw_only=True)

    def value(self, b):
        return fn.fiscal_year(b.column(self.period))


@dataclass(frozen=True)
class NumberOf(Spec):
    """Two-digit member number ``01..NN`` of a small dimension."""

    table: str

    def value(self, b):
        members = max(1, b.size_of(self.table))
        if members > 99:
            raise ValueError(f"{b.table}.{self.name} numbers its members with two digits; {self.table} has {members}")
        return fn.padded(fn.ref(b.draw(self.name), members), 2)


@dataclass(frozen=True)
class PaddedId(Spec):
    """Zero-padded id, as wide as the table it belongs to needs; the row's own unless ``key`` refers to it."""

    table: str
    pad: int
    key: str | None = None

    def value(self, b):
        number = b.column(self.key) if self.key else b.id
        return fn.padded(number, b.width(self.pad, b.size_of(self.table)))


@dataclass(frozen=True)
class Label(Spec):
    """Text with ``{column}`` places, NULL when any of them is NULL."""

    form: str

    def value(self, b):
        return F.concat(*[b.column(body) if is_column else F.lit(body) for body, is_column in self.pieces()])

    def pieces(self) -> list[tuple[str, bool]]:
        found = []
        for chunk in self.form.split("{"):
            head, closed, tail = chunk.partition("}")
            if not closed:
                found.append((head, False))
            else:
                found += [(head, True), (tail, False)]
        return [(body, is_column) for body, is_column in found if body]


@dataclass(frozen=True)
class Constant(Spec):
    constant: str
    takes = "list"

    def refusal(self, own):
        return super().refusal(own) or ("it has one value" if len(own.values) != 1 else None)

    def value(self, b):
        own = b.domain(self.name)
        return F.lit(str(own.values[0]) if own else self.constant).cast(self.type)


@dataclass(frozen=True)
class Relation:
    column: str
    ref_table: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    columns: tuple[Spec, ...]
    max_rows: int | None = None

    def fields(self) -> list[tuple[str, str]]:
        return [pair for spec in self.columns for pair in spec.fields()]

    def relations(self) -> list[Relation]:
        return [Relation(s.name, s.table) for s in self.columns
                if isinstance(s, (Ref, TextRef, Period)) and s.declared]

    def check_rows(self, rows: int) -> None:
        if self.max_rows is not None and rows > self.max_rows:
            raise ValueError(f"{self.name} has at most {self.max_rows} distinct rows, not {rows}")

    def check_domains(self, b: Build) -> None:
        """Raise where a domain does not suit its column, or a pair's columns are not drawn alike."""
        refused = {}
        for name, spec in b.owners.items():
            own = b.domain(name)
            why = spec.refusal(own) if own else None
            if own and not why and own.draws_as:
                partner = b.domain(own.draws_as)
                why = self.unpaired(name, own, b.owners.get(own.draws_as), partner, b)
            if why:
                refused[name] = why
        if refused:
            raise ValueError(f"{self.name}: no domain can replace these values: {refused}")

    @staticmethod
    def unpaired(name: str, own: Domain, partner: Spec | None, other: Domain | None, b: Build) -> str | None:
        """Why a pair's two columns would not name the same member, if they would not."""
        spec = b.owners[name]
        if partner is None:
            return f"its partner {own.draws_as} is not in the table"
        if other is None or len(other.values) != len(own.values) or other.weights != own.weights or other.draws_as:
            return f"another domain replaced that of its partner {own.draws_as}"
        if type(partner) is not type(spec) or not isinstance(spec, (Pick, Cycle, CodeOf)):
            return f"it is not drawn as its partner {own.draws_as} is"
        if isinstance(spec, Cycle) and spec.every != partner.every:
            return f"it is not repeated as its partner {own.draws_as} is"
        if isinstance(spec, CodeOf) and (spec.key, spec.table) != (partner.key, partner.table):
            return f"it follows other ids than its partner {own.draws_as}"
        if isinstance(spec, Pick) and not b.options.independent_codes and partner.draws_as:
            return f"its partner {own.draws_as} is drawn as {partner.draws_as}"
        return None

    def project(self, source: DataFrame, b: Build, columns: Sequence[str] | None = None,
                extra: Sequence[tuple[str, Column]] = ()) -> DataFrame:
        """One select over the row ids: a narrow stage, whatever the column count."""
        self.check_rows(b.rows)
        b.owners = {name: spec for spec in self.columns for name, _ in spec.fields()}
        lost = [name for name in b.domains if name.startswith(f"{self.name}.")
                and name.split(".", 1)[1] not in b.owners]
        if lost:
            raise KeyError(f"domains for columns that {self.name} does not have: {lost}")
        self.check_domains(b)
        names = list(b.owners) if columns is None else list(columns)
        unknown = [name for name in names if name not in b.owners]
        if unknown:
            raise KeyError(f"{self.name} has no columns {unknown}")
        return source.select(*[b.column(name).alias(name) for name in names],
                             *[column.alias(name) for name, column in extra])


def level_family(stem: str, levels: int, first_full: int, step: float, **shapes: str) -> tuple[Spec, ...]:
    """``{stem}_{n}_{suffix}`` for every level, with a NULL rate that rises by ``step`` below ``first_full``."""
    return tuple(
        Template(f"{stem}_{level}_{suffix}", template, path=stem,
                 null_rate=clamp_rate(round((level - first_full) * step, 6)))
        for level in range(1, levels + 1)
        for suffix, template in shapes.items()
    )


def words(name: str, *lengths: int, null_rate: float = 0.0) -> Template:
    """Upper-case words of the given lengths."""
    return Template(name, " ".join("r" * n for n in lengths), null_rate=null_rate)


def flag(name: str = "active_ind", yes: int = 90) -> Pick:
    return Pick(name, ("Y", "N"), (yes, 100 - yes))


def user_id(name: str) -> Template:
    return Template(name, "addrr_ddddd", null_rate=0.01)


def audit_users() -> tuple[Spec, ...]:
    return user_id("created_by_user_id"), user_id("updated_by_user_id")

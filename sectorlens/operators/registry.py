"""Register querying: F01-F12, P01, P02, P04, S08, S09, O01, J07.

``RegistryQuery`` is an immutable, fluent predicate builder over a companies
``DataFrame``. Every clause is a ``Column`` (or a semi-join against a code
table); ``fetch()`` AND-s them into one ``filter`` that Catalyst pushes into
the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import broadcast_if_small


class RequestError(ValueError):
    """A request that the variable catalog does not allow."""


class UnknownVariable(RequestError):
    """No such variable in the catalog."""


class VariableNotOwned(RequestError):
    """The variable may not be used."""


class OperatorNotAllowed(RequestError):
    """The variable does not take this operator."""


# Register operator names and the builder method each maps to.
OPERATOR_METHODS = {
    "Innehaller": "contains",
    "ArLikaMed": "equals",
    "BorjarPa": "prefix",
    "FranOchMed": "start_from",
    "TillOchMed": "up_to",
    "Mellan": "between",
    "Finns": "exists",
    "FinnsInte": "exists",
}

ALL_METHODS = sorted(set(OPERATOR_METHODS.values()))


@dataclass(frozen=True)
class Variable:
    column: str
    methods: tuple[str, ...]
    owned: bool = True


def default_catalog(df: DataFrame, owned: list[str] | None = None) -> dict[str, Variable]:
    """Every column is a variable supporting every operator; ``owned``
    restricts which ones may be used."""
    return {c: Variable(c, tuple(ALL_METHODS), owned is None or c in owned) for c in df.columns}


def exists_expr(col: str, exists: bool = True) -> Column:
    """a value is present (non-null and not only white space)."""
    present = F.col(col).isNotNull() & (F.trim(F.col(col).cast("string")) != "")
    return present if exists else ~present


@dataclass(frozen=True)
class RegistryQuery:
    df: DataFrame
    catalog: dict
    clauses: tuple = ()
    semis: tuple = ()            # (column expression, code DataFrame, code column, exclude)
    base: bool = True            # F10: active and registered companies only

    # -- validation (F12) -----------------------------------------------------
    def _check(self, method: str, names) -> None:
        for name in names:
            found = self.catalog.get(name)
            if found is None:
                raise UnknownVariable(f"unknown variable {name!r}")
            if method not in found.methods if found.owned else True:
                kind = OperatorNotAllowed if found.owned else VariableNotOwned
                raise kind(f"{method!r} on {name!r}: allowed are {list(found.methods) if found.owned else 'no operators'}")

    def _col(self, v: str) -> Column:
        return F.col(self.catalog[v].column)

    def _typed(self, v: str, value):
        # values arrive as strings; compare in the column's own type
        dtype = self.df.schema[self.catalog[v].column].dataType
        return F.lit(value).cast(dtype)

    def _add(self, *cols: Column) -> "RegistryQuery":
        return replace(self, clauses=self.clauses + tuple(cols))

    # -- variable operators (F01-F07) -------------------------------------------
    def exists(self, variables: list[str], exists: bool = True) -> "RegistryQuery":
        self._check("exists", variables)
        return self._add(*[exists_expr(self.catalog[v].column, exists) for v in variables])

    def contains(self, spec: dict) -> "RegistryQuery":
        self._check("contains", spec)
        return self._add(*[F.contains(self._col(v).cast("string"), F.lit(s)) for v, s in spec.items()])

    def equals(self, spec: dict) -> "RegistryQuery":
        self._check("equals", spec)
        return self._add(*[self._col(v) == self._typed(v, s) for v, s in spec.items()])

    def prefix(self, spec: dict) -> "RegistryQuery":
        self._check("prefix", spec)
        return self._add(*[F.startswith(self._col(v).cast("string"), F.lit(s)) for v, s in spec.items()])

    def start_from(self, spec: dict) -> "RegistryQuery":
        self._check("start_from", spec)
        return self._add(*[self._col(v) >= self._typed(v, s) for v, s in spec.items()])

    def up_to(self, spec: dict) -> "RegistryQuery":
        self._check("up_to", spec)
        return self._add(*[self._col(v) <= self._typed(v, s) for v, s in spec.items()])

    def between(self, spec: dict) -> "RegistryQuery":
        self._check("between", spec)
        return self._add(*[self._col(v).between(self._typed(v, lo), self._typed(v, hi))
                           for v, (lo, hi) in spec.items()])

    # -- categories (F08, F09) ---------------------------------------------------
    def sni(self, codes, level: int = 1, exclusion: bool = False,
            all_codes: DataFrame | None = None, branch_col: str = "branch_codes") -> "RegistryQuery":
        """the ``level``-th branch code is one of ``codes``; with
        ``exclusion`` it is one of all known codes except ``codes`` (O01)."""
        if not 1 <= level <= 3:
            raise ValueError("level must be 1..3")
        slot = F.get(F.col(branch_col), level - 1)
        if exclusion:
            if all_codes is None:
                raise ValueError("exclusion needs the table of all codes")
            keep = exclude_codes(all_codes, codes)
            return replace(self, semis=self.semis + ((slot, keep, "sni_code"),))
        if isinstance(codes, DataFrame):
            return replace(self, semis=self.semis + ((slot, codes, codes.columns[0]),))
        return self._add(slot.isin(list(codes)))

    def category(self, codes, cat: str = "municipality_code") -> "RegistryQuery":
        """category membership (seat municipality, legal form, ...)."""
        col = F.col(self.catalog[cat].column) if cat in self.catalog else F.col(cat)
        if isinstance(codes, DataFrame):
            return replace(self, semis=self.semis + ((col, codes, codes.columns[0]),))
        return self._add(col.isin(list(codes)))

    # -- terminals (F11) -------------------------------------------------------------
    def predicate(self) -> Column:
        cols = list(self.clauses)
        if self.base:
            cols = [base_filter()] + cols
        return reduce(and_, cols) if cols else F.lit(True)

    def fetch(self) -> DataFrame:
        out = self.df.filter(self.predicate())
        for i, (col, codes, code_col) in enumerate(self.semis):
            key = f"_k{i}"
            small = broadcast_if_small(codes.select(F.col(code_col).alias(key)).distinct())
            out = out.withColumn(key, col).join(small, key, "left_semi").drop(key)
        return out

    def count(self) -> DataFrame:
        return self.fetch().agg(F.count(F.lit(1)).alias("n"))

    def reset(self) -> "RegistryQuery":
        return replace(self, clauses=(), semis=())


def base_filter(status: str = "company_status", registration: str = "registration_status") -> Column:
    """active (status 1) and registered (status 1) companies."""
    return (F.col(status) == "1") & (F.col(registration) == "1")


# -- P01: wide register row -> companies --------------------------------------------

# Register field names and the company attribute each becomes.
REGISTER_FIELDS = {
    "Företagsnamn": "name",
    "OrgNr": "org_nr",
    "PostAdress": "address",
    "PostNr": "postal_code",
    "PostOrt": "postal_city",
    "Säteskommun, kod": "municipality_code",
    "Säteskommun": "municipality",
    "Telefon": "phone",
}


def is_branch_field(name: str) -> bool:
    return "Bransch_" in name and "kod" in name and "P" not in name and "HAE" not in name


def normalise_register(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rename the known fields, collect every branch-code field (in
    column order, blanks kept) into ``branch_codes``, default ``url = ''``.
    The field-name rule runs once on the schema."""
    keep = keep or []
    branch = [c for c in raw.columns if is_branch_field(c)]
    renamed = [F.col(f"`{src}`").alias(dst) for src, dst in REGISTER_FIELDS.items() if src in raw.columns]
    return raw.select(
        *[F.col(c) for c in keep], *renamed,
        F.array(*[F.col(f"`{c}`") for c in branch]).alias("branch_codes") if branch
        else F.array().cast("array<string>").alias("branch_codes"),
        F.lit("").alias("url"))


def as_map(dim: DataFrame, key: str, value: str) -> DataFrame:
    """A dimension as a one-row ``code -> name`` map (small, fixed
    dimensions only: the map is held in one row)."""
    return dim.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("map"))


def variable_catalog(all_vars: DataFrame, owned: DataFrame) -> DataFrame:
    """Variables with their operators mapped to builder methods and an
    ``owned`` flag. ``all_vars``: (variable, operators); ``owned``: (variable)."""
    m = F.create_map(*[x for k, v in OPERATOR_METHODS.items() for x in (F.lit(k), F.lit(v))])
    o = owned.select("variable").distinct().withColumn("_owned", F.lit(True))
    return (all_vars.join(broadcast_if_small(o), "variable", "left")
            .select("variable",
                    F.transform("operators", lambda op: m[op]).alias("methods"),
                    F.coalesce("_owned", F.lit(False)).alias("owned")))


def judge_requests(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """F12 for a table of requests (variable, method) against the catalog of
    ``variable_catalog``: adds ``verdict`` (ok, unknown, not owned, not allowed)."""
    found = catalog.withColumn("_known", F.lit(True))
    verdict = (F.when(F.col("_known").isNull(), "unknown").when(~F.col("owned"), "not owned")
               .when(~F.array_contains("methods", F.col("method")), "not allowed").otherwise("ok"))
    return (requests.join(broadcast_if_small(found), "variable", "left")
            .withColumn("verdict", verdict).drop("methods", "owned", "_known"))


def municipalities_from_categories(tables: DataFrame, col: str = "tables") -> DataFrame:
    """Entry 4 of the category tables holds the municipalities."""
    return (tables.select(F.explode(F.get(F.col(col), 4)["VardeLista"]).alias("v"))
            .select(F.col("v.Varde").alias("code"), F.col("v.Text").alias("name")))


def legal_forms_from_categories(tables: DataFrame, include: DataFrame, col: str = "tables") -> DataFrame:
    """Values of the 'Juridisk form' table, kept when on the include list."""
    cats = tables.select(F.explode(F.col(col)).alias("t")).filter(F.col("t.Id_Kategori_JE") == "Juridisk form")
    vals = cats.select(F.explode("t.VardeLista").alias("v")).select(
        F.col("v.Varde").alias("code"), F.col("v.Text").alias("description"))
    inc = broadcast_if_small(include.select(F.col(include.columns[0]).alias("code")))
    return vals.join(inc, "code", "left_semi")


def exclude_codes(all_codes: DataFrame, codes) -> DataFrame:
    """All codes minus the given ones."""
    if isinstance(codes, DataFrame):
        return all_codes.join(codes.select(F.col(codes.columns[0]).alias("sni_code")), "sni_code", "left_anti")
    return all_codes.filter(~F.col("sni_code").isin(list(codes)))


def restrict_companies(companies: DataFrame, sni_code: str, municipality: str,
                       legal_forms: DataFrame, branch_col: str = "branch_codes",
                       form_col: str = "legal_form") -> DataFrame:
    """Active, registered companies (F10) of one code in one municipality
    with an included legal form."""
    forms = broadcast_if_small(legal_forms.select(F.col(legal_forms.columns[0]).alias(form_col)).distinct())
    return (companies.filter(base_filter() & (F.get(F.col(branch_col), 0) == sni_code)
                             & (F.col("municipality_code") == municipality))
            .join(forms, form_col, "left_semi"))

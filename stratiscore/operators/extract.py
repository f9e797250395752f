"""Extraction: one clean profile per client, and the client's finances.

Every aggregation combines inside the map tasks before the shuffle, so a client holding a large
share of the rows sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiscore.config import ID, NOTE_COLUMNS, Settings
from stratiscore.functions.cleaning import text
from stratiscore.operators.selection import hash_of, sample_by_hash
from stratiscore.sources.staging import Workspace
from stratiscore.sources.warehouse import Warehouse

# Preference among several codes of one client, and defaults.
HOUSING_RANK = {"1": 1, "2": 2, "6": 3}
HOUSING_RANK_OTHER = 11
FAMILY_RANK = {"Célibataire": 1, "Marié": 2, "Concubin": 3}
FAMILY_RANK_OTHER = 7
OCCUPATION_RANK = {"3": 1, "2": 2}
OCCUPATION_RANK_OTHER = 9
DEFAULT_HOUSING = "NC"
DEFAULT_FAMILY = "Non renseigné"
DEFAULT_OCCUPATION = "9"
DEFAULT_ORG_CODE = "NC"
DEFAULT_ORG_NAME = "Non renseigné"
LIQUID_SAVINGS_SOURCE = "FEPAVE02"

CORE_INTEGERS = ("AGE", "FRONTALIER", "nb_majeur", "nb_enfant")
ORG_COLUMNS = ("num_dsc", "nom_dsc", "num_pole", "nom_pole", "num_agence", "nom_agence")
FINANCIAL_DOUBLES = (
    "PNB_ASSU",
    "PNB_COLL",
    "PNB_CRED",
    "PNB_SERV",
    "SLD_DAV",
    "EP_LIQUIDE",
    "EP_STABLE",
    "amount",
)
FINANCIAL_INTEGERS = ("frequency", "recency")


def _ranked(value: str, ranks: dict[str, int], other: int) -> str:
    """A code in its order of preference; ties go to the smallest value, NULL last."""
    cases = " ".join(f"when {text(code)} then {rank}" for code, rank in ranks.items())
    rank = f"case {value} {cases} else {other} end"
    return f"struct({rank} as rank, {value} is null as empty, {value} as v)"


# Of each code: its order, whose minimum is the preferred one, and the value that is kept of it.
_CODE_ORDER = {
    "CD_OCC_LGT": _ranked("trim(CD_OCC_LGT)", HOUSING_RANK, HOUSING_RANK_OTHER),
    "CDSIFA": _ranked("CDSIFA", FAMILY_RANK, FAMILY_RANK_OTHER),
    "CDPCSP": _ranked("cast(CDPCSP as string)", OCCUPATION_RANK, OCCUPATION_RANK_OTHER),
}


def _code_value(name: str, best: str) -> str:
    return f"substring(lpad({best}.v, 2, '0'), 1, 1)" if name == "CDPCSP" else f"{best}.v"


CODES = {name: _code_value(name, f"min({order})") for name, order in _CODE_ORDER.items()}
HOUSING, FAMILY, OCCUPATION = CODES["CD_OCC_LGT"], CODES["CDSIFA"], CODES["CDPCSP"]
CODE_DEFAULTS = {
    "CD_OCC_LGT": DEFAULT_HOUSING,
    "CDSIFA": DEFAULT_FAMILY,
    "CDPCSP": DEFAULT_OCCUPATION,
}


def _aggregate(df: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(f"{sql} as {name}") for name, sql in sums.items()])


def _eligible(settings: Settings) -> str:
    return (
        f"AGE between {settings.age_min} and {settings.age_max} "
        f"and nb_majeur >= {settings.nb_majeur_min}"
    )


def core_base(clients: DataFrame, settings: Settings) -> DataFrame:
    """Clients with an eligible row; the largest value of each count among those rows."""
    largest = {name: f"cast(max({name}) as int)" for name in CORE_INTEGERS}
    return _aggregate(clients.filter(_eligible(settings)), [ID], largest)


def housing_priority(clients: DataFrame) -> DataFrame:
    return _aggregate(clients, [ID], {"CD_OCC_LGT": HOUSING})


def family_priority(clients: DataFrame) -> DataFrame:
    return _aggregate(clients, [ID], {"CDSIFA": FAMILY})


def occupation_priority(clients: DataFrame) -> DataFrame:
    return _aggregate(clients, [ID], {"CDPCSP": OCCUPATION})


def _largest_counts(settings: Settings) -> dict[str, str]:
    eligible = _eligible(settings)
    return {c: f"cast(max(if({eligible}, {c}, null)) as int)" for c in CORE_INTEGERS}


def _core_aggregates(settings: Settings) -> dict[str, str]:
    return {**_largest_counts(settings), **CODES}


def _core_columns() -> list[str]:
    # Rows without a client id form one group of their own, which never finds its codes.
    coded = [
        f"coalesce(if({ID} is not null, {name}, null), {text(default)}) as {name}"
        for name, default in CODE_DEFAULTS.items()
    ]
    return [ID, *CORE_INTEGERS, *coded]


def core_extract(clients: DataFrame, settings: Settings) -> DataFrame:
    """Base, housing, family and occupation of each eligible client, in one aggregation.

    Codes are chosen among all rows of a client, counts among its eligible rows only. An eligible
    row has an age, so a client without one is told by a missing maximum.
    """
    grouped = _aggregate(clients, [ID], _core_aggregates(settings))
    return grouped.filter("AGE is not null").selectExpr(*_core_columns())


def _org_pick() -> str:
    """Aggregate: the row with an agency, then with a pole; further ties by its values."""
    tie = ("num_agence", "nom_agence", "num_pole", "nom_pole", "num_dsc", "nom_dsc")
    values = []
    for name in tie:
        default = DEFAULT_ORG_CODE if name.startswith("num_") else DEFAULT_ORG_NAME
        values.append(f"coalesce(trim({name}), {text(default)}) as {name}")
    return (
        "min(struct(if(num_agence != '', 1, 2) as agency, if(num_pole != '', 1, 2) as pole, "
        f"{', '.join(values)}))"
    )


def org_extract(clients: DataFrame) -> DataFrame:
    """Organisation of each client: one row per id."""
    known = clients.filter(f"{ID} is not null")
    return _aggregate(known, [ID], {"org": _org_pick()}).selectExpr(
        ID, *[f"org.{name}" for name in ORG_COLUMNS]
    )


def client_profile(clients: DataFrame, settings: Settings) -> DataFrame:
    """Core and organisation columns together, in one aggregation by client."""
    wanted = {**_core_aggregates(settings), "org": _org_pick()}
    org = [f"if({ID} is not null, org.{name}, null) as {name}" for name in ORG_COLUMNS]
    return (
        _aggregate(clients, [ID], wanted)
        .filter("AGE is not null")
        .selectExpr(*_core_columns(), *org)
    )


_REVENUE = {
    "PNB_ASSU": "sum(MT_PNB_ASSU_AGLS)",
    "PNB_COLL": "sum(MT_PNB_COLCT_AGLS)",
    "PNB_CRED": "sum(MT_PNB_CRED_AGLS) + sum(MT_PNB_ADI_AGLS)",
    "PNB_SERV": "sum(MT_PNB_SERV_FACTN_AGLS)",
}


def pnb_by_client(clients: DataFrame) -> DataFrame:
    """Revenue by client and combination of notes; credit is NULL when either part is."""
    return _aggregate(clients, [ID, *NOTE_COLUMNS], _REVENUE)


class ClientStates:
    """All that is read of the client table, from one scan: profiles, both their parts, revenue.

    The table is aggregated by client and combination of notes. Such a group holds its revenue, and
    minima and maxima that go on to be aggregated by client: few rows for each client, however many
    it has in the table. ``states`` is read several times, so it should be staged.
    """

    def __init__(self, states: DataFrame):
        self.states = states

    @staticmethod
    def aggregate(clients: DataFrame, settings: Settings) -> DataFrame:
        codes = {f"_{name}": f"min({order})" for name, order in _CODE_ORDER.items()}
        wanted = {**_REVENUE, **_largest_counts(settings), **codes, "_org": _org_pick()}
        return _aggregate(clients, [ID, *NOTE_COLUMNS], wanted)

    def _by_client(self, with_core: bool, with_org: bool) -> DataFrame:
        wanted = {}
        if with_core:
            wanted |= {c: f"max({c})" for c in CORE_INTEGERS}
            wanted |= {name: _code_value(name, f"min(_{name})") for name in _CODE_ORDER}
        if with_org:
            wanted["org"] = "min(_org)"
        return _aggregate(self.states, [ID], wanted)

    def core(self) -> DataFrame:
        return self._by_client(True, False).filter("AGE is not null").selectExpr(*_core_columns())

    def org(self) -> DataFrame:
        known = self._by_client(False, True).filter(f"{ID} is not null")
        return known.selectExpr(ID, *[f"org.{name}" for name in ORG_COLUMNS])

    def profile(self) -> DataFrame:
        org = [f"if({ID} is not null, org.{name}, null) as {name}" for name in ORG_COLUMNS]
        grouped = self._by_client(True, True).filter("AGE is not null")
        return grouped.selectExpr(*_core_columns(), *org)

    def revenue(self) -> DataFrame:
        return self.states.select(ID, *NOTE_COLUMNS, *_REVENUE)


def savings_split(savings: DataFrame) -> DataFrame:
    """Liquid and stable savings; a row of unknown source counts in neither."""
    liquid = text(LIQUID_SAVINGS_SOURCE)
    return _aggregate(
        savings,
        [ID],
        {
            "liquide": f"sum(if(fichier_source = {liquid}, MONTANT, 0D))",
            "stable": f"sum(if(fichier_source != {liquid}, MONTANT, 0D))",
        },
    )


def account_totals(
    accounts: DataFrame, insurance_savings: DataFrame, savings: DataFrame
) -> DataFrame:
    """Balances, savings and activity of ids with an account, in one aggregation of all three.

    Ids meet as they are written. Rows without id do not meet: their savings are nobody's.
    """
    liquid = text(LIQUID_SAVINGS_SOURCE)
    rows = (
        accounts.withColumn("_account", F.lit(1))
        .unionByName(insurance_savings, allowMissingColumns=True)
        .unionByName(savings, allowMissingColumns=True)
    )
    return _aggregate(
        rows,
        [ID],
        {
            "accounts": "count(_account)",
            "balance": "sum(SLD_MOY_12_MOIS)",
            "insurance": f"sum(if({ID} is null, null, MT_ENCRS))",
            "liquide": f"sum(if({ID} is not null and fichier_source = {liquid}, MONTANT, 0D))",
            "stable": f"sum(if({ID} is not null and fichier_source != {liquid}, MONTANT, 0D))",
            **_ACTIVITY,
        },
    ).filter("accounts > 0")


_ACTIVITY = {
    "frequency": "sum(NB_OPERN_DBTR_MOIS)",
    "amount": "avg(FLUX_MENS)",
    "recency": "min(RECENCY)",
}
_WEALTH = (
    "coalesce(balance, 0D) as SLD_DAV",
    "round(coalesce(liquide, 0D), 2) as EP_LIQUIDE",
    "round(coalesce(insurance, 0D) + coalesce(stable, 0D), 2) as EP_STABLE",
)


def wealth_by_client(
    accounts: DataFrame, insurance_savings: DataFrame, savings: DataFrame
) -> DataFrame:
    """Balances and savings of clients with an account.

    Ids lose their trailing blanks only in the result.
    """
    totals = account_totals(accounts, insurance_savings, savings)
    return totals.selectExpr(f"rtrim({ID}) as {ID}", *_WEALTH)


def rfm(accounts: DataFrame) -> DataFrame:
    return _aggregate(accounts, [ID], _ACTIVITY)


def financial_extract(warehouse: Warehouse, revenue: DataFrame | None = None) -> DataFrame:
    """Revenue, wealth and account activity of every client known to any of them.

    ``revenue`` by client and notes may have been read already. A full join of the three, as one aggregation: the few rows that each has for an id are
    collected and multiplied out. Ids without blanks and as written meet only here.
    """
    revenue = pnb_by_client(warehouse.clients) if revenue is None else revenue
    totals = account_totals(warehouse.accounts, warehouse.insurance_savings, warehouse.savings)
    pnb = ", ".join(c for c in revenue.columns if c != ID)
    tagged = revenue.selectExpr(ID, f"struct({pnb}) as pnb")
    # The two readings of an account row leave one scan of the totals.
    readings = totals.selectExpr(
        "explode(array(0, 1)) as reading", ID, *_WEALTH, *_ACTIVITY
    ).selectExpr(
        f"if(reading = 0, rtrim({ID}), {ID}) as {ID}",
        "if(reading = 0, struct(SLD_DAV, EP_LIQUIDE, EP_STABLE), null) as wealth",
        "if(reading = 1, struct(frequency, amount, recency), null) as activity",
    )
    rows = tagged.unionByName(readings, allowMissingColumns=True)
    # Rows without id stay alone.
    alone = f"if({ID} is null, xxhash64(pnb, wealth is null, activity is null), null) as _alone"
    joined = (
        rows.selectExpr("*", alone)
        .groupBy(ID, "_alone")
        .agg(*[F.collect_list(c).alias(c) for c in ("pnb", "wealth", "activity")])
        .selectExpr(ID, "wealth", "activity", "explode_outer(pnb) as pnb")
        .selectExpr(ID, "pnb", "activity", "explode_outer(wealth) as wealth")
        .selectExpr(ID, "pnb", "wealth", "explode_outer(activity) as activity")
        .selectExpr(ID, "pnb.*", "wealth.*", "activity.*")
    )
    types = {field.name: field.dataType.typeName() for field in joined.schema}
    zeros = {c: "'0'" if types[c] == "string" else "0" for c in NOTE_COLUMNS}
    return joined.selectExpr(
        ID,
        *[f"coalesce({c}, {zeros[c]}) as {c}" for c in NOTE_COLUMNS],
        *[f"cast(coalesce({c}, 0) as double) as {c}" for c in FINANCIAL_DOUBLES],
        *[f"cast(coalesce({c}, 0) as bigint) as {c}" for c in FINANCIAL_INTEGERS],
    )


def all_data(profile: DataFrame, financial: DataFrame) -> DataFrame:
    """Profiles with their finances; a client with several note rows comes several times."""
    return profile.join(financial, ID, "left")


def _sample_key(id_column: str, seed: int) -> str:
    return f"concat({id_column}, '{seed}')"


def sample_n(df: DataFrame, n: int | None, seed: int, workspace: Workspace) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run; the default size without ``n``."""
    n = workspace.settings.default_sample_size if n is None else n
    ties = [name for name in NOTE_COLUMNS if name in df.columns]
    return sample_by_hash(df, _sample_key(ID, seed), n, [ID, *ties], workspace)


def sample_condition(eligible: DataFrame, n: int | None, seed: int, workspace: Workspace) -> str:
    """A condition on ids that all clients of a sample of ``n`` rows meet, and few others.

    ``eligible`` has the ids of the clients to sample from. A sample takes rows by the hash of their
    id, and each client has at least one row: none lies beyond the hash of the n-th id. Accounts
    meet clients as written or without trailing blanks, so either form will do.
    """
    n = workspace.settings.default_sample_size if n is None else n
    first = sample_by_hash(eligible.select(ID).distinct(), _sample_key(ID, seed), n, [ID], workspace)
    last = first.agg(F.expr(f"max({hash_of(_sample_key(ID, seed))})")).first()[0]
    if last is None:
        return "false"
    forms = (hash_of(_sample_key(form, seed)) for form in (ID, f"rtrim({ID})"))
    return " or ".join(f"{form} <= '{last}'" for form in forms)


def sampled_warehouse(
    warehouse: Warehouse, n: int | None, seed: int, settings: Settings, workspace: Workspace
) -> Warehouse:
    """The source rows that a sample of ``n`` rows of the full extraction can need.

    Extraction from it aggregates these rows only; a sample of it is that of the full extraction.
    """
    eligible = warehouse.clients.filter(_eligible(settings))
    return warehouse.where(sample_condition(eligible, n, seed, workspace))

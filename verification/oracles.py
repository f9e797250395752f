"""The queries as SQL for DuckDB, put together from named steps."""

from __future__ import annotations

import re

from stratiscore.sources.warehouse import CLIENTS, CONTRACTS
from verification.queries import SAMPLE_SIZE, SEED
from verification.views import VIEWS

NOTES = (
    "CD_NOTE_UNVRS_ASSU",
    "CD_NOTE_UNVRS_CRED",
    "CD_NOTE_UNVRS_EPRGN",
    "CD_NOTE_UNVRS_SERV",
    "CD_NOTE_POIDS_UNVRS",
    "CD_NOTE_MIRE",
)
PNB = ("PNB_COLL", "PNB_CRED", "PNB_SERV", "PNB_ASSU")
FEATURES = (
    "Situation_Couple",
    "Situation_Celibataire",
    "REVENU_Score",
    "Enfants_Avec",
    "Enfants_Sans",
    "Logement_Proprietaire",
    "Logement_NonProprietaire",
)
AGE_GROUPS = ("Age_Jeunes", "Age_Actifs", "Age_Seniors", "Age_Retraites")
ORG = ("num_dsc", "nom_dsc", "num_pole", "nom_pole", "num_agence", "nom_agence")
LABEL_ORDER = ("A construire", "A stimuler", "A developper", "A entretenir")


def each(pattern: str, names, sep: str = ", ") -> str:
    return sep.join(pattern.replace("@", name) for name in names)


def r6(expression: str, name: str) -> str:
    return f"round(cast({expression} as double), 6) + 0.0 as {name}"


def rounded(names) -> str:
    return ", ".join(r6(n, n) for n in names)


def ints(names) -> str:
    return each("cast(@ as bigint) as @", names)


def preferred(value: str, rank: str, name: str) -> str:
    return f"""
select ID_DWR_CLI_CIAL, v as {name} from (
 select ID_DWR_CLI_CIAL, {value} as v, row_number() over (
  partition by ID_DWR_CLI_CIAL order by {rank}, {value} nulls last) as rn
 from connaissance_client) where rn = 1"""


SQUARES = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(FEATURES)))
STRATUM = (
    "case "
    + " ".join(
        f"when AGE between {low} and {low + 4} then '{low}-{low + 4}'" for low in range(18, 59, 5)
    )
    + " when AGE >= 63 then '63+' end"
)
GIVEN = "Situation_Couple * 2 + Enfants_Avec"
PART_CODE = "Situation_Couple + 2 * Enfants_Avec + 4 * Logement_Proprietaire + 8 * REVENU_Score"


def silhouettes(points: str, key: str = "strate") -> str:
    """Mean silhouette by ``key`` of points (key, part, z0.., n), for keys of several parts."""
    return f"""
select {key}, sum(n * case when na = 1 or greatest(inner_d, outer_d) = 0 then 0
   else (outer_d - inner_d) / greatest(inner_d, outer_d) end) / sum(n) as silhouette,
 sum(n) as n
from (
 select {key}, pid, any_value(n) as n, max(case when own then weight end) as na,
  max(case when own then total / greatest(weight - 1, 1) end) as inner_d,
  min(case when not own then total / weight end) as outer_d
 from (
  select a.{key}, a.pid, a.n, a.part = b.part as own, b.part, sum(b.n) as weight,
   sum(b.n * sqrt({SQUARES})) as total
  from {points} a join {points} b on a.{key} = b.{key}
  group by a.{key}, a.pid, a.n, a.part, b.part)
 group by {key}, pid having count(*) > 1)
group by {key}"""


Z = [f"z{i}" for i in range(len(FEATURES))]
_Z = ", ".join(Z)


def z_of(alias: str) -> str:
    return ", ".join(f"{alias}.{z}" for z in Z)


# The fit, step by step: points, starts, further centers of each start, Lloyd steps of all runs
# (strate, k, start), the best run, labels of the points, silhouettes, and the number of clusters.
N_STARTS, MAX_K, MAX_STEPS = 10, 6, 300
FIT_STEPS: dict[str, str] = {
    "folded": f"""
select *, row_number() over (partition by strate order by {_Z}) as pid,
 row_number() over (partition by strate order by n desc, {_Z}) as start,
 count(*) over (partition by strate) as n_points
from (select strate, {_Z}, count(*) as n from scaled group by strate, {_Z})""",
    "trials": f"""
select strate, unnest(range(2, 1 + greatest(2, least({MAX_K},
 n_clients // (select min_cluster from limits))))) as k from viable""",
    "seeding": f"""
select a.strate, b.start, 0 as c, b.pid as picked, a.pid, a.n_points, {SQUARES} as least_d
from folded a join folded b on a.strate = b.strate where b.start <= {N_STARTS}
union all
select a.strate, f.start, f.c + 1, f.far, a.pid, a.n_points, least(s.least_d, {SQUARES})
from (select s.strate, s.start, any_value(s.c) as c,
  min({{'worth': -s.least_d * a.n, 'pid': s.pid}}).pid as far
  from seeding s join folded a on s.strate = a.strate and s.pid = a.pid
  where s.c + 1 < least({MAX_K}, s.n_points) group by s.strate, s.start) f
 join seeding s on s.strate = f.strate and s.start = f.start
 join folded a on a.strate = s.strate and a.pid = s.pid
 join folded b on b.strate = f.strate and b.pid = f.far""",
    "lloyd": f"""
select t.strate, t.k, s.start, 0 as step, s.c, {z_of('a')}
from trials t join (select distinct strate, start, c, picked from seeding) s
 on t.strate = s.strate and s.c < t.k
 join folded a on a.strate = s.strate and a.pid = s.picked
union all
(with nearest as (
 select a.strate, b.k, b.start, a.pid, any_value(a.n) as n, {each('any_value(a.@) as @', Z)},
  min({{'d': round_even(({SQUARES}) * 1e9, 0), 'c': b.c}}) as own
 from folded a join lloyd b on a.strate = b.strate group by a.strate, b.k, b.start, a.pid),
means as (
 select strate, k, start, own.c as c, {each('fsum(n * @) / sum(n) as @', Z)}
 from nearest group by strate, k, start, own.c),
farthest as (
 select strate, k, start, min({{'d': -own.d, 'pid': pid}}).pid as pid
 from nearest group by strate, k, start),
moved as (
 select b.strate, b.k, b.start, b.step + 1 as step, b.c,
  {each('round(coalesce(m.@, f.@), 10) + 0.0 as @', Z)},
  {each('b.@ <> round(coalesce(m.@, f.@), 10) + 0.0', Z, ' or ')} as changed
 from lloyd b left join means m
  on m.strate = b.strate and m.k = b.k and m.start = b.start and m.c = b.c
 join farthest w on w.strate = b.strate and w.k = b.k and w.start = b.start
 join folded f on f.strate = w.strate and f.pid = w.pid)
select strate, k, start, step, c, {_Z} from (
 select *, bool_or(changed) over (partition by strate, k, start) as going from moved)
where going and step <= {MAX_STEPS})""",
    "settled": """
select * from (select *, max(step) over (partition by strate, k, start) as last from lloyd)
where step = last""",
    "run_points": f"""
select a.strate, b.k, b.start, a.pid, any_value(a.n) as n,
 min({{'d': round_even(({SQUARES}) * 1e9, 0), 'c': b.c}}) as own
from folded a join settled b on a.strate = b.strate group by a.strate, b.k, b.start, a.pid""",
    "best_runs": """
select strate, k, min({'cost': round(cost / greatest(top, 1e-300), 9), 'start': start}).start as start
from (select *, max(cost) over (partition by strate, k) as top from (
 select strate, k, start, sum(own.d * n) / 1e9 as cost from run_points group by strate, k, start))
group by strate, k""",
    "fit_centers": f"""
select s.strate, s.k, {z_of('s')}, row_number() over (partition by s.strate, s.k
 order by u.size desc, {each('round(s.@, 9)', Z)}) - 1 as c
from settled s join best_runs r on s.strate = r.strate and s.k = r.k and s.start = r.start
 join (select strate, k, start, own.c as c, sum(n) as size from run_points group by all) u
 on s.strate = u.strate and s.k = u.k and s.start = u.start and s.c = u.c""",
    "fit_points": f"""
select concat(strate, '|', cast(k as varchar)) as fit, * exclude (own), own.c as part from (
 select a.strate, b.k, a.pid, any_value(a.n) as n, {each('any_value(a.@) as @', Z)},
  min({{'d': round_even(({SQUARES}) * 1e9, 0), 'c': b.c}}) as own
 from folded a join fit_centers b on a.strate = b.strate group by a.strate, b.k, a.pid)""",
    "fit_silhouettes": silhouettes("fit_points", "fit"),
    "fit_sizes": """
select fit, strate, k, part, sum(n) as size from fit_points group by fit, strate, k, part""",
    "fit_chosen": """
select strate, k, silhouette, sizes from (
 select m.*, s.silhouette, row_number() over (partition by m.strate order by s.silhouette desc, m.k) as rn
 from (select fit, any_value(strate) as strate, any_value(k) as k, min(size) as least_size,
   string_agg(cast(size as varchar), ',' order by part) as sizes from fit_sizes group by fit) m
 join fit_silhouettes s on m.fit = s.fit
 where m.least_size >= (select min_cluster from limits) and s.silhouette > -1) where rn = 1""",
}
# Steps that read their own rows.
RECURSIVE = frozenset(("seeding", "lloyd"))

# Steps in order; each may use those before it.
STEPS: dict[str, str] = {
    **VIEWS,
    "limits": """
select greatest(1, count(*) * 475 // 10000) as min_strata,
 greatest(2, count(*) * 67 // 10000) as min_cluster from customer""",
    "core_base": """
select ID_DWR_CLI_CIAL, cast(max(AGE) as int) as AGE, cast(max(FRONTALIER) as int) as FRONTALIER,
 cast(max(nb_majeur) as int) as nb_majeur, cast(max(nb_enfant) as int) as nb_enfant
from connaissance_client where AGE >= 18 and AGE <= 100 and nb_majeur >= 1
group by ID_DWR_CLI_CIAL""",
    "lgt": preferred(
        "trim(CD_OCC_LGT)",
        "case trim(CD_OCC_LGT) when '1' then 1 when '2' then 2 when '6' then 3 else 11 end",
        "CD_OCC_LGT",
    ),
    "sifa": preferred(
        "CDSIFA",
        "case CDSIFA when 'Célibataire' then 1 when 'Marié' then 2 when 'Concubin' then 3 "
        "else 7 end",
        "CDSIFA",
    ),
    "csp_raw": preferred(
        "CDPCSP", "case CDPCSP when '3' then 1 when '2' then 2 else 9 end", "CDPCSP"
    ),
    "csp": """
select ID_DWR_CLI_CIAL, substring(lpad(CDPCSP, 2, '0'), 1, 1) as CDPCSP from csp_raw""",
    "core": """
select b.*, coalesce(CD_OCC_LGT, 'NC') as CD_OCC_LGT, coalesce(CDSIFA, 'Non renseigné') as CDSIFA,
 coalesce(CDPCSP, '9') as CDPCSP
from core_base b left join lgt using (ID_DWR_CLI_CIAL) left join sifa using (ID_DWR_CLI_CIAL)
 left join csp using (ID_DWR_CLI_CIAL)""",
    "org": f"""
select ID_DWR_CLI_CIAL, {', '.join(ORG)} from (
 select *, row_number() over (partition by ID_DWR_CLI_CIAL order by agency, pole,
  num_agence, nom_agence, num_pole, nom_pole, num_dsc, nom_dsc) as rn
 from (select ID_DWR_CLI_CIAL,
  case when num_agence is not null and num_agence <> '' then 1 else 2 end as agency,
  case when num_pole is not null and num_pole <> '' then 1 else 2 end as pole,
  {each("coalesce(trim(@), 'NC') as @", [c for c in ORG if c.startswith('num')])},
  {each("coalesce(trim(@), 'Non renseigné') as @", [c for c in ORG if c.startswith('nom')])}
  from connaissance_client where ID_DWR_CLI_CIAL is not null)) where rn = 1""",
    "pnb": f"""
select ID_DWR_CLI_CIAL, {', '.join(NOTES)}, sum(MT_PNB_ASSU_AGLS) as PNB_ASSU,
 sum(MT_PNB_COLCT_AGLS) as PNB_COLL, sum(MT_PNB_CRED_AGLS) + sum(MT_PNB_ADI_AGLS) as PNB_CRED,
 sum(MT_PNB_SERV_FACTN_AGLS) as PNB_SERV
from connaissance_client group by ID_DWR_CLI_CIAL, {', '.join(NOTES)}""",
    "split": """
select ID_DWR_CLI_CIAL,
 sum(case when fichier_source = 'FEPAVE02' then MONTANT else 0 end) as liquide,
 sum(case when fichier_source <> 'FEPAVE02' then MONTANT else 0 end) as stable
from epargne group by ID_DWR_CLI_CIAL""",
    "wealth": """
select rtrim(b.ID_DWR_CLI_CIAL) as ID_DWR_CLI_CIAL, coalesce(a, 0) as SLD_DAV,
 round(coalesce(liquide, 0), 2) as EP_LIQUIDE,
 round(coalesce(i, 0) + coalesce(stable, 0), 2) as EP_STABLE
from (select ID_DWR_CLI_CIAL, sum(SLD_MOY_12_MOIS) as a from baq group by ID_DWR_CLI_CIAL) b
 left join (select ID_DWR_CLI_CIAL, sum(MT_ENCRS) as i from epargne_assurance
  group by ID_DWR_CLI_CIAL) e on b.ID_DWR_CLI_CIAL = e.ID_DWR_CLI_CIAL
 left join split s on b.ID_DWR_CLI_CIAL = s.ID_DWR_CLI_CIAL""",
    "rfm": """
select ID_DWR_CLI_CIAL, cast(sum(NB_OPERN_DBTR_MOIS) as bigint) as frequency,
 avg(FLUX_MENS) as amount, min(RECENCY) as recency from baq group by ID_DWR_CLI_CIAL""",
    "fin": f"""
select ID_DWR_CLI_CIAL,
 {each('coalesce(@, 0) as @', NOTES[:-1])}, coalesce(CD_NOTE_MIRE, '0') as CD_NOTE_MIRE,
 {each('cast(coalesce(@, 0) as double) as @',
       (*PNB, 'SLD_DAV', 'EP_LIQUIDE', 'EP_STABLE', 'amount'))},
 {each('cast(coalesce(@, 0) as bigint) as @', ('frequency', 'recency'))}
from pnb full join wealth using (ID_DWR_CLI_CIAL) full join rfm using (ID_DWR_CLI_CIAL)""",
    "everything": f"""
select * from core left join org using (ID_DWR_CLI_CIAL) left join fin using (ID_DWR_CLI_CIAL)""",
    "features": """
select ID_DWR_CLI_CIAL, couple as Situation_Couple, 1 - couple as Situation_Celibataire, AGE,
 case when FRONTALIER = 1 then 3 when CDPCSP in ('2', '3') then 2
  when CDPCSP in ('1', '4', '5', '6') then 1 else 0 end as REVENU_Score,
 children as Enfants_Avec, 1 - children as Enfants_Sans,
 owner as Logement_Proprietaire, 1 - owner as Logement_NonProprietaire,
 case when AGE >= 18 and AGE < 30 then 1 else 0 end as Age_Jeunes,
 case when AGE >= 30 and AGE < 50 then 1 else 0 end as Age_Actifs,
 case when AGE >= 50 and AGE < 65 then 1 else 0 end as Age_Seniors,
 case when AGE >= 65 then 1 else 0 end as Age_Retraites
from (select *, case when coalesce(nb_majeur, 1) >= 2 or lower(CDSIFA) like '%marié%'
  or lower(CDSIFA) like '%marie%' or lower(CDSIFA) like '%concubin%'
  or lower(CDSIFA) like '%pacsé%' or lower(CDSIFA) like '%pacse%' then 1 else 0 end as couple,
 case when coalesce(nb_enfant, 0) > 0 then 1 else 0 end as children,
 case when CD_OCC_LGT = '1' then 1 else 0 end as owner from core)""",
    "stratified": f"select *, {STRATUM} as strate from features",
    "strata_names": "select unnest(["
    + ", ".join(f"'{low}-{low + 4}'" for low in range(18, 59, 5))
    + ", '63+']) as strate",
    "counts": """
select s.strate, count(f.strate) as n_clients,
 count(f.strate) < (select min_strata from limits) as under_threshold
from strata_names s left join stratified f on s.strate = f.strate group by s.strate""",
    "viable": "select strate, n_clients from counts where not under_threshold",
    "scaled": f"""
select ID_DWR_CLI_CIAL, strate, {GIVEN} as part, {PART_CODE} as code,
 {', '.join(f'''case when max({c}) over w = min({c}) over w then 0.0
  else ({c} - avg({c}) over w) / stddev_pop({c}) over w end as z{i}'''
            for i, c in enumerate(FEATURES))}
from stratified where strate in (select strate from viable) window w as (partition by strate)""",
    "points": f"""
select *, row_number() over () as pid from (
 select strate, part, code, {', '.join(f'any_value(z{i}) as z{i}' for i in range(len(FEATURES)))},
  count(*) as n from scaled group by strate, part, code)""",
    **FIT_STEPS,
    "given_silhouettes": silhouettes("points"),
    "given_quality": """
select p.strate, cast(sum(p.n) as bigint) as n_clients, count(distinct p.part) as n_clusters,
 coalesce(round(any_value(s.silhouette), 9), 0.0) as silhouette
from points p left join given_silhouettes s on p.strate = s.strate group by p.strate""",
    "quality": """
select cast(coalesce(sum(n_clusters), 0) as bigint) as total_clusters,
 cast(coalesce(sum(n_clients), 0) as bigint) as total_clustered_clients,
 count(*) as viable_strata,
 cast(count(*) filter (not silhouette > 0) as bigint) as single_cluster_strata,
 cast(count(*) filter (n_clusters = 1) as bigint) as one_cluster_strata,
 coalesce(avg(silhouette) filter (silhouette > 0), 0) as avg_silhouette_score,
 coalesce(min(silhouette) filter (silhouette > 0), 0) as min_silhouette_score,
 coalesce(max(silhouette) filter (silhouette > 0), 0) as max_silhouette_score,
 coalesce(stddev_pop(silhouette) filter (silhouette > 0), 0) as silhouette_std
from given_quality""",
    "importances": f"""
select strate, feature, var_pop(center) as importance from (
 {' union all '.join(f"""select strate, part, '{c}' as feature, avg(z{i}) as center
  from scaled group by strate, part""" for i, c in enumerate(FEATURES))})
group by strate, feature""",
    "labelled": f"""
select s.ID_DWR_CLI_CIAL, s.AGE,
 case when v.strate is null then 'NON_CLUSTERED' else s.strate end as CLUSTER_STRATE,
 case when v.strate is null then -1 else {GIVEN} end as CLUSTER_LOCAL,
 case when v.strate is null then 'NON_CLUSTERED'
  else concat(s.strate, '_C', cast({GIVEN} as varchar)) end as CLUSTER_GLOBAL
from stratified s left join viable v on s.strate = v.strate""",
    "joined": """
select * from labelled join fin using (ID_DWR_CLI_CIAL) where CLUSTER_GLOBAL <> 'NON_CLUSTERED'""",
    "prep_any": f"""
select *, PNB_COLL + PNB_CRED + PNB_SERV + PNB_ASSU as PNB_TOTAL,
 EP_LIQUIDE + EP_STABLE as TOTAL_EPARGNE,
 case when EP_LIQUIDE + EP_STABLE > 200 then
  least(greatest(greatest(SLD_DAV, 200) / (EP_LIQUIDE + EP_STABLE), 0), 1) else 0.0 end as EP_RATIO
from (select * replace (coalesce(try_cast(CD_NOTE_MIRE as double), 0) as CD_NOTE_MIRE) from fin)""",
    "prepared": """
select l.*, p.* exclude (ID_DWR_CLI_CIAL) from labelled l join prep_any p using (ID_DWR_CLI_CIAL)
where CLUSTER_GLOBAL <> 'NON_CLUSTERED'""",
    "stats": f"""
select CLUSTER_GLOBAL, count(*) as n_cluster, {each('avg(@) as mean_@', PNB)},
 {each('min(@) as min_@', PNB)}, {each('max(@) as max_@', PNB)}
from prepared group by CLUSTER_GLOBAL""",
    "weights": f"""
select *, {each('case when total_mean = 0 then 0 else abs(mean_@) / total_mean end as WEIGHT_@', PNB)}
from (select *, {each('abs(mean_@)', PNB, ' + ')} as total_mean from stats)""",
    "normed": f"""
select p.*, w.* exclude (CLUSTER_GLOBAL),
 {each('''case when max_@ - min_@ > 1e-6 then (@ - min_@) / (max_@ - min_@) else 0.0 end
  as @_NORM''', PNB)}
from prepared p join weights w using (CLUSTER_GLOBAL)""",
    "scored": f"""
select *, {each('@_NORM * WEIGHT_@ as @_WEIGHTED', PNB)},
 round({each('@_NORM * WEIGHT_@', PNB, ' + ')}, 10) as CLIENT_SCORE from normed""",
    "top": f"""
select * from (select *, row_number() over (partition by CLUSTER_GLOBAL order by CLIENT_SCORE desc,
 md5(ID_DWR_CLI_CIAL), ID_DWR_CLI_CIAL, {', '.join(NOTES)}, EP_RATIO) as place from scored)
where place <= greatest(1, floor(n_cluster * 0.25))""",
    "medians": f"""
select CLUSTER_GLOBAL, {each('median(@) as @_MEDIAN', (*PNB, 'EP_RATIO'))}
from top group by CLUSTER_GLOBAL""",
    "potential": """
select *, POTENTIAL_PNB_COLL + POTENTIAL_PNB_CRED + POTENTIAL_PNB_SERV + POTENTIAL_PNB_ASSU
 as TOTAL_POTENTIAL from (select s.*, m.* exclude (CLUSTER_GLOBAL),
 case when EP_RATIO > EP_RATIO_MEDIAN then
  (EP_RATIO - EP_RATIO_MEDIAN) / (1 - EP_RATIO_MEDIAN + 1e-6) * PNB_COLL_MEDIAN else 0 end
  as POTENTIAL_PNB_COLL,
 case when CD_NOTE_UNVRS_CRED = 0 then greatest(PNB_CRED_MEDIAN - greatest(PNB_CRED, 0), 0)
  else 0 end as POTENTIAL_PNB_CRED,
 greatest(PNB_SERV_MEDIAN - greatest(PNB_SERV, 0), 0) as POTENTIAL_PNB_SERV,
 greatest(PNB_ASSU_MEDIAN - greatest(PNB_ASSU, 0), 0) as POTENTIAL_PNB_ASSU
from scored s join medians m using (CLUSTER_GLOBAL))""",
    "quantiles": """
select CLUSTER_GLOBAL, median(CLIENT_SCORE) as SCORE_MEDIAN,
 quantile_cont(CLIENT_SCORE, 0.25) as SCORE_Q25, quantile_cont(CLIENT_SCORE, 0.75) as SCORE_Q75
from scored group by CLUSTER_GLOBAL""",
    "final": """
select *, case when SEGMENT_FINAL = 8 then 'A entretenir' when SEGMENT_FINAL >= 6 then 'A developper'
 when SEGMENT_FINAL >= 4 then 'A stimuler' else 'A construire' end as SEGMENTATION_FINALE
from (select *, SEGMENT_PNB + SEGMENT_MIRE as SEGMENT_FINAL
from (select *, case when CLIENT_SCORE >= SCORE_Q75 then 4 when CLIENT_SCORE >= SCORE_MEDIAN then 3
  when CLIENT_SCORE >= SCORE_Q25 then 2 else 1 end as SEGMENT_PNB,
 case when CD_NOTE_MIRE >= 75 then 4 when CD_NOTE_MIRE >= 50 then 3 when CD_NOTE_MIRE >= 25 then 2
  else 1 end as SEGMENT_MIRE
from potential join quantiles using (CLUSTER_GLOBAL)))""",
    "per_cluster": """
select CLUSTER_GLOBAL, count(*) as n_clients, avg(CLIENT_SCORE) as avg_score,
 sum(TOTAL_POTENTIAL) as total_potential, avg(TOTAL_POTENTIAL) as avg_potential,
 any_value(dominant) as dominant_segment
from final join (
 select CLUSTER_GLOBAL, SEGMENTATION_FINALE as dominant from (
  select CLUSTER_GLOBAL, SEGMENTATION_FINALE, row_number() over (partition by CLUSTER_GLOBAL
   order by count(*) desc, SEGMENTATION_FINALE) as rn
  from final group by CLUSTER_GLOBAL, SEGMENTATION_FINALE) where rn = 1)
using (CLUSTER_GLOBAL) group by CLUSTER_GLOBAL""",
    "profile": """
select count(*) as n_rows, count(*) - count(AGE) as invalid_ages, min(AGE) as age_min,
 max(AGE) as age_max, avg(AGE) as age_mean, stddev_samp(AGE) as age_std from features""",
    "trained": """
select count(*) as n_samples, avg(AGE) as trained_mean, stddev_samp(AGE) as trained_std
from features where cast(right(ID_DWR_CLI_CIAL, 1) as int) % 2 = 1""",
    "drift": """
select abs(age_mean - trained_mean) as age_mean_drift, abs(age_std - trained_std) as age_std_drift,
 n_rows / n_samples as volume_ratio from profile, trained""",
    "covered": """
select count(*) as total, count(*) filter (CLUSTER_GLOBAL <> 'NON_CLUSTERED') as clustered,
 count(*) filter (CLUSTER_GLOBAL = 'NON_CLUSTERED') as not_clustered,
 count(*) filter (CLUSTER_GLOBAL <> 'NON_CLUSTERED') / count(*) as clustered_ratio from labelled""",
    "report": """
select drift.*, avg_silhouette_score as avg_silhouette,
 single_cluster_strata / greatest(viable_strata, 1) as single_ratio, clustered_ratio
from drift, quality, covered""",
    "months": """
select *, '202501' as MOIS_ANNEE, 2025 as ANNEE, 1 as MOIS from final
union all select *, '202502', 2025, 2 from final where SEGMENT_FINAL >= 4""",
    "parts_by_k": f"""
select concat(strate, '|', cast(k as varchar)) as strate, code % k as part, n, pid,
 {', '.join(f'z{i}' for i in range(len(FEATURES)))}
from points, (select unnest([2, 3, 4, 5, 6]) as k)""",
    "candidates": f"""
select split_part(s.strate, '|', 1) as strate, cast(split_part(s.strate, '|', 2) as int) as k,
 round(s.silhouette, 9) as silhouette, m.min_size
from ({silhouettes('parts_by_k')}) s join (
 select strate, min(size) as min_size from (
  select strate, part, sum(n) as size from parts_by_k group by strate, part) group by strate) m
 on s.strate = m.strate""",
    "centers": f"""
select strate, dense_rank() over (partition by strate order by part) - 1 as cluster,
 {', '.join(f'avg(z{i}) as z{i}' for i in range(len(FEATURES)))}
from scaled group by strate, part""",
    "odd_points": f"""
select *, row_number() over () as pid from (
 select strate, part, code, {', '.join(f'any_value(z{i}) as z{i}' for i in range(len(FEATURES)))},
  count(*) as n from scaled where cast(right(ID_DWR_CLI_CIAL, 1) as int) % 2 = 1
 group by strate, part, code)""",
}
# The steps as a whole run has them: clients repeated for their note combinations, fitted labels.
_OWN_FEATURES = """
select f.* from client_features f join everything e
 on f.ID_DWR_CLI_CIAL is not distinct from e.ID_DWR_CLI_CIAL"""
_FITTED_LABELS = f"""
select s.ID_DWR_CLI_CIAL, s.strate as CLUSTER_STRATE, coalesce(p.part, 0) as CLUSTER_LOCAL,
 concat(s.strate, '_C', cast(coalesce(p.part, 0) as varchar)) as CLUSTER_GLOBAL
from scaled s left join fit_chosen f on s.strate = f.strate
 left join fit_points p on p.strate = s.strate and p.k = f.k
  and {each('round(p.@, 9) = round(s.@, 9)', Z, ' and ')}"""
RUN_STEPS: dict[str, str] = {}
for _name, _text in STEPS.items():
    if _name == "features":
        RUN_STEPS["client_features"] = _text
    RUN_STEPS[_name] = {"features": _OWN_FEATURES, "labelled": _FITTED_LABELS}.get(_name, _text)

KEY = (
    "ID_DWR_CLI_CIAL, CLUSTER_GLOBAL, " + r6("CD_NOTE_POIDS_UNVRS", "CD_NOTE_POIDS_UNVRS")
)
FINANCIAL = f"""{ints(NOTES[:-1])}, CD_NOTE_MIRE,
 {rounded((*PNB, 'SLD_DAV', 'EP_LIQUIDE', 'EP_STABLE', 'amount'))}, {ints(('frequency', 'recency'))}"""
CORE = "ID_DWR_CLI_CIAL, AGE, FRONTALIER, nb_majeur, nb_enfant, CD_OCC_LGT, CDSIFA, CDPCSP"
METRICS = f"""CLUSTER_GLOBAL, cast(n_clients as bigint) as n_clients,
 {rounded(('avg_score', 'total_potential', 'avg_potential'))}, dominant_segment"""


def percent(share: str, name: str) -> str:
    return f"cast(round_even(cast({share} as double) * 100, 0) as int) as {name}"


def holding(note: str, name: str) -> str:
    return f"""case when (select max({note}) from final) > 0 then cast(round_even(
  {note} / cast((select max({note}) from final) as double) * 100, 0) as int) else 0 end as {name}"""


QUERIES: dict[str, str] = {
    "scan_clients": """select num_dsc, count(*) as n_rows, count(AGE) as n_ages,
 sum(MT_PNB_CRED_AGLS) as credit from connaissance_client group by num_dsc""",
    "core_base": "select * from core_base",
    "housing_priority": "select * from lgt",
    "family_priority": "select * from sifa",
    "occupation_priority": "select * from csp",
    "core_extract": f"select {CORE} from core",
    "org_extract": "select * from org",
    "pnb_by_client": f"""select ID_DWR_CLI_CIAL, {ints(NOTES[:-1])}, CD_NOTE_MIRE, {rounded(PNB)}
from pnb""",
    "wealth_by_client": "select * from wealth",
    "savings_split": "select * from split",
    "rfm": f"""select ID_DWR_CLI_CIAL, {ints(('frequency', 'recency'))}, {rounded(('amount',))}
from rfm""",
    "financial_extract": f"select ID_DWR_CLI_CIAL, {FINANCIAL} from fin",
    "all_data": f"select {CORE}, {', '.join(ORG)}, {FINANCIAL} from everything",
    "sample_n": f"""select ID_DWR_CLI_CIAL, AGE,
 cast(CD_NOTE_POIDS_UNVRS as bigint) as CD_NOTE_POIDS_UNVRS
from everything order by md5(concat(ID_DWR_CLI_CIAL, '{SEED}')), ID_DWR_CLI_CIAL,
 {each('@ nulls first', NOTES)} limit {SAMPLE_SIZE}""",
    "clean_labels": """select ID_DWR_CLI_CIAL, case when CLUSTER_GLOBAL is null
 or CLUSTER_GLOBAL in ('', 'nan', 'None', 'null') then 'NON_CLUSTERED' else CLUSTER_GLOBAL end
 as CLUSTER_GLOBAL from raw_labels""",
    "coerce_notes": """select ID_DWR_CLI_CIAL, max(note) as note, count(note) as n_rows from (
 select ID_DWR_CLI_CIAL, coalesce(try_cast(CD_NOTE_MIRE as double), 0) as note
 from connaissance_client) group by ID_DWR_CLI_CIAL""",
    "age_validity": """select count(*) as n_rows, count(*) - count(AGE) as invalid_ages
from connaissance_client""",
    "encode_household": """select ID_DWR_CLI_CIAL, Situation_Couple, Situation_Celibataire
from features""",
    "encode_age": """select ID_DWR_CLI_CIAL, AGE, Age_Jeunes, Age_Actifs, Age_Seniors, Age_Retraites
from features""",
    "encode_income": "select ID_DWR_CLI_CIAL, REVENU_Score from features",
    "encode_children": "select ID_DWR_CLI_CIAL, Enfants_Avec, Enfants_Sans from features",
    "encode_housing": """select ID_DWR_CLI_CIAL, Logement_Proprietaire, Logement_NonProprietaire
from features""",
    "feature_table": f"select ID_DWR_CLI_CIAL, AGE, {', '.join(FEATURES)} from features",
    "feature_table_global": f"""select ID_DWR_CLI_CIAL, {', '.join(FEATURES)}, Age_Jeunes,
 Age_Actifs, Age_Seniors, Age_Retraites from features""",
    "assign_stratum": "select ID_DWR_CLI_CIAL, AGE, strate from stratified",
    "stratum_counts": "select * from counts",
    "viable_strata": "select * from viable",
    "standardize": f"""select ID_DWR_CLI_CIAL, strate,
 {', '.join(r6(f'z{i}', f'z_{c}') for i, c in enumerate(FEATURES))} from scaled""",
    "stratum_points": f"""select strate, {', '.join(FEATURES)}, count(*) as n from stratified
where strate is not null group by strate, {', '.join(FEATURES)}""",
    "kmeans_fit": """select strate, n_clients, true as k_in_range, true as sizes_ok,
 true as centers_are_means, true as as_good from viable""",
    "kmeans_quality": f"""select strate, n_clients, cast(coalesce(k, 1) as int) as n_clusters,
 {r6('coalesce(silhouette, 0)', 'silhouette')}, coalesce(sizes, cast(n_clients as varchar)) as sizes
from viable left join fit_chosen using (strate)""",
    "global_mode": """select case when v.strate is null then 'NON_CLUSTERED' else s.strate end
 as CLUSTER_STRATE, count(*) as n_clients,
 cast(sum(Age_Jeunes) as bigint) as jeunes, cast(sum(Age_Actifs) as bigint) as actifs,
 cast(sum(Age_Seniors) as bigint) as seniors, cast(sum(Age_Retraites) as bigint) as retraites
from stratified s left join viable v on s.strate = v.strate group by 1""",
    "select_k": f"""select strate, coalesce(k, 1) as k, {r6('coalesce(silhouette, 0)', 'silhouette')}
from (select distinct strate from candidates) left join (
 select strate, k, silhouette from (select *, row_number() over (partition by strate
  order by silhouette desc, k) as rn from candidates
  where min_size >= (select min_cluster from limits) and silhouette > -1) where rn = 1)
 using (strate)""",
    "silhouette": f"""select strate, {r6('silhouette', 'silhouette')}, cast(n as bigint) as n
from given_silhouettes""",
    "feature_importance": f"""select strate, feature, {r6('importance', 'importance')}
from importances""",
    "global_importance": f"""select feature,
 {r6('sum(importance * n_clients) / sum(n_clients)', 'importance')}
from importances join viable using (strate) group by feature""",
    "assign_cluster": f"""select ID_DWR_CLI_CIAL, coalesce(c.strate, 'NON_CLUSTERED')
  as CLUSTER_STRATE, cast(coalesce(cluster, -1) as int) as CLUSTER_LOCAL,
 case when c.strate is null then 'NON_CLUSTERED'
  else concat(c.strate, '_C', cast(cluster as varchar)) end as CLUSTER_GLOBAL
from features left join (
 select a.ID_DWR_CLI_CIAL, a.strate, b.cluster, row_number() over (partition by a.ID_DWR_CLI_CIAL
  order by floor(({SQUARES}) * 1e9 + 0.5), b.cluster) as rn
 from scaled a join centers b on a.strate = b.strate) c
 using (ID_DWR_CLI_CIAL) where coalesce(rn, 1) = 1""",
    "cluster_labels": """select ID_DWR_CLI_CIAL, CLUSTER_STRATE, CLUSTER_LOCAL, CLUSTER_GLOBAL
from labelled""",
    "cluster_sizes": """select CLUSTER_STRATE, CLUSTER_LOCAL, count(*) as n_clients from labelled
where CLUSTER_GLOBAL <> 'NON_CLUSTERED' group by CLUSTER_STRATE, CLUSTER_LOCAL""",
    "cluster_quality": f"""select total_clusters, total_clustered_clients, viable_strata,
 single_cluster_strata, one_cluster_strata, {rounded(('avg_silhouette_score',
 'min_silhouette_score', 'max_silhouette_score', 'silhouette_std'))} from quality""",
    "training_meta": f"""select cast(n_rows as bigint) as n_samples, cast(7 as bigint) as n_features,
 cast(age_min as bigint) as age_min, cast(age_max as bigint) as age_max,
 {rounded(('age_mean', 'age_std'))} from profile""",
    "score_input": f"""select ID_DWR_CLI_CIAL, CLUSTER_GLOBAL, {rounded(PNB)}, CD_NOTE_MIRE
from joined""",
    "financial_prep": f"""select ID_DWR_CLI_CIAL, {rounded((*PNB, 'PNB_TOTAL', 'EP_LIQUIDE',
 'EP_STABLE', 'SLD_DAV', 'TOTAL_EPARGNE', *NOTES))} from prep_any""",
    "savings_ratio": f"""select ID_DWR_CLI_CIAL, {rounded(('CD_NOTE_POIDS_UNVRS', 'EP_RATIO'))}
from prep_any""",
    "pnb_weights": f"""select CLUSTER_GLOBAL, {rounded([f'WEIGHT_{c}' for c in PNB])}
from weights""",
    "pnb_norm": f"select {KEY}, {rounded([f'{c}_NORM' for c in PNB])} from normed",
    "client_score": f"""select {KEY},
 {rounded([*[f'{c}_WEIGHTED' for c in PNB], 'CLIENT_SCORE'])} from scored""",
    "top_quarter": f"select {KEY}, {rounded(('CLIENT_SCORE',))} from top",
    "top_medians": f"""select CLUSTER_GLOBAL,
 {rounded([f'{c}_MEDIAN' for c in (*PNB, 'EP_RATIO')])} from medians""",
    "potentials": f"""select {KEY},
 {rounded([*[f'POTENTIAL_{c}' for c in PNB], 'TOTAL_POTENTIAL'])} from potential""",
    "score_quantiles": f"""select CLUSTER_GLOBAL,
 {rounded(('SCORE_MEDIAN', 'SCORE_Q25', 'SCORE_Q75'))} from quantiles""",
    "segmentation": f"""select {KEY}, SEGMENT_PNB, SEGMENT_MIRE, SEGMENT_FINAL, SEGMENTATION_FINALE
from final""",
    "scored_clients": f"""select {KEY}, CLUSTER_STRATE, {rounded(('PNB_TOTAL', 'EP_RATIO',
 'CLIENT_SCORE', 'TOTAL_POTENTIAL'))}, SEGMENT_FINAL, SEGMENTATION_FINALE from final""",
    "scoring_metrics": f"""select count(*) as total_clients,
 count(distinct CLUSTER_GLOBAL) as clusters_count, {r6('avg(CLIENT_SCORE)', 'avg_client_score')},
 {r6('sum(TOTAL_POTENTIAL)', 'total_potential_value')},
 {r6('sum(TOTAL_POTENTIAL) / count(*)', 'avg_potential_per_client')},
 {r6('count(*) filter (CLIENT_SCORE > 0) / count(*)', 'score_coverage')},
 {r6('count(*) filter (TOTAL_POTENTIAL > 0) / count(*)', 'potential_coverage')} from final""",
    "segment_distribution": f"""select SEGMENTATION_FINALE, count(*) as n_clients,
 {r6('count(*) * 100.0 / (select count(*) from final)', 'pct')}
from final group by SEGMENTATION_FINALE""",
    "cluster_metrics": f"select {METRICS} from per_cluster",
    "top_clusters": f"""select * from (select {METRICS} from per_cluster)
order by avg_potential desc, CLUSTER_GLOBAL limit 5""",
    "scoring_quality": """select count(*) filter (CLIENT_SCORE > 0) as clients_scored,
 count(*) filter (TOTAL_POTENTIAL > 0) as clients_with_potential,
 (select count(*) from per_cluster where n_clients >= 50) as clusters_viable,
 count(distinct SEGMENTATION_FINALE) >= 3 as segments_balanced from final""",
    "export_essential": f"""select ID_DWR_CLI_CIAL, CLUSTER_GLOBAL,
 {rounded(('CLIENT_SCORE', 'TOTAL_POTENTIAL'))}, SEGMENTATION_FINALE, SEGMENT_PNB, SEGMENT_MIRE
from final""",
    "export_completion": f"""select ID_DWR_CLI_CIAL as clientId,
 case SEGMENTATION_FINALE when 'A construire' then 0 when 'A stimuler' then 1
  when 'A developper' then 2 when 'A entretenir' then 3 else 1 end as segmentNumber,
 {percent('''case when max(CLIENT_SCORE) over w - min(CLIENT_SCORE) over w > 1e-6
  then (CLIENT_SCORE - min(CLIENT_SCORE) over w)
   / (max(CLIENT_SCORE) over w - min(CLIENT_SCORE) over w) else 0.5 end''', 'pnbPercentage')},
 {percent('PNB_CRED_NORM', 'pnbCredit')}, {percent('PNB_SERV_NORM', 'pnbBAQ')},
 {percent('PNB_ASSU_NORM', 'pnbAssurance')}, {percent('PNB_COLL_NORM', 'pnbEpargne')},
 {holding('CD_NOTE_UNVRS_CRED', 'detentionCredit')},
 {holding('CD_NOTE_UNVRS_SERV', 'detentionBAQ')},
 {holding('CD_NOTE_UNVRS_ASSU', 'detentionAssurance')},
 {holding('CD_NOTE_UNVRS_EPRGN', 'detentionEpargne')},
 cast(trunc(CD_NOTE_MIRE) as int) as notesMire
from final window w as (partition by CLUSTER_GLOBAL)""",
    "snapshot_save": """select 'core_data' as dataset, '202501' as period, count(*) as n_rows from core
union all select 'core_data', '202502', count(*) from core
union all select 'organizational_data', '202502', count(*) from org""",
    "snapshot_status": """select 'core_data' as dataset, '202501' as period, 'CACHE_VALID' as status,
 count(*) as n_rows from core
union all select 'core_data', '202502', 'CACHE_EXPIRED:202501', 0
union all select 'processed_data', '202501', 'CACHE_OLD_FORMAT', 0
union all select 'financial_data', '202501', 'CACHE_NOT_FOUND', 0""",
    "persist_month": f"""select MOIS_ANNEE, ANNEE, MOIS, SEGMENTATION_FINALE, count(*) as n_clients,
 {r6('sum(TOTAL_POTENTIAL)', 'total_potential')}
from months group by MOIS_ANNEE, ANNEE, MOIS, SEGMENTATION_FINALE""",
    "month_state": """select MOIS_ANNEE, count(*) as total from months group by MOIS_ANNEE
order by MOIS_ANNEE desc limit 5""",
    "snapshot_clear": """select 'core_data' as dataset, '202502' as period, count(*) as n_rows
from core""",
    "read_through": """select step, cast(builds as bigint) as builds, n_rows
from (values ('first', 1), ('again', 1), ('refreshed', 2), ('unused', 3)) t(step, builds),
 (select count(*) as n_rows from core)""",
    "period_keys": """select strftime(d, '%Y%m') as period, max(month(d)) as month,
 count(*) as n_days from (select distinct o_orderdate as d from orders) group by 1""",
    "dev_output": f"""select SEGMENTATION_FINALE, count(*) as n_clients,
 {r6('sum(TOTAL_POTENTIAL)', 'total_potential')}, (select count(*) from final) as told
from final group by SEGMENTATION_FINALE""",
    "run_history": f"""select run_date, status, clients_scored, {rounded(('potentiel_total',))} from (
 select strftime(cast(training_date as timestamp), '%Y-%m-%d %H:%M:%S') as run_date,
  case when total_clusters % 3 = 0 then 'failed' else 'success' end as status,
  cast(n_samples as bigint) as clients_scored, cast(total_clusters as double) as potentiel_total,
  training_date from model_history
 union all select '2030-01-01 00:00:00', 'success', 7, 0.5, date '2030-01-01')
order by training_date desc limit 100""",
    "renamed_columns": f"""select SEGMENTATION_FINALE, count(*) as n_clients,
 {r6('sum(TOTAL_POTENTIAL)', 'total_potential')} from final group by SEGMENTATION_FINALE""",
    "required_columns": f"""select name, true as required, cast(0 as bigint) as n_rows
from (select unnest([{', '.join(f"'{c}'" for c in CONTRACTS[CLIENTS])}]) as name), core
group by name""",
    "feature_columns": " union all ".join(
        f"""select '{mode}' as mode, cast({i} as bigint) as place, '{c}' as feature,
 cast(sum({c}) as bigint) as total from features"""
        for mode, names in (("stratifie", FEATURES), ("global", (*FEATURES[:2], *AGE_GROUPS, *FEATURES[2:])))
        for i, c in enumerate(names)
    ),
    "shortcuts": f"""select 'extract_data' as name, count(*) as n_rows,
 count(distinct ID_DWR_CLI_CIAL) as n_clients from everything
union all select 'extract_data_sample', least(count(*), 300), (select count(distinct i) from (
 select ID_DWR_CLI_CIAL as i from everything order by md5(concat(ID_DWR_CLI_CIAL, '{SEED}')),
 ID_DWR_CLI_CIAL limit 300)) from everything
union all select 'extract_features', count(*), count(distinct ID_DWR_CLI_CIAL) from everything
union all select 'extract_and_cluster', count(*), count(distinct ID_DWR_CLI_CIAL)
from everything""",
    "latest_model": """select model_version from model_history
order by training_date desc, model_version desc limit 1""",
    "history_retention": f"""select model_version,
 {ints(('n_samples', 'total_clusters', 'viable_strata'))}, {rounded(('avg_silhouette_score',))}
from model_history order by training_date desc, model_version desc limit 100""",
    "model_status": f"""select 'v1' as model_version, '2025-01-15' as training_date,
 cast(n_samples as bigint) as n_samples, total_clusters, viable_strata,
 {r6('avg_silhouette_score', 'avg_silhouette')} from trained, quality""",
    "age_profile": f"""select {ints(('n_rows', 'invalid_ages'))},
 {rounded(('age_min', 'age_max', 'age_mean', 'age_std'))} from profile""",
    "input_drift": f"""select {rounded(('age_mean_drift', 'age_std_drift'))},
 age_mean_drift > 2 as mean_warning, age_std_drift > 1 as std_warning from drift""",
    "model_drift": f"""select {rounded(('age_mean_drift', 'age_std_drift', 'volume_ratio'))}
from drift""",
    "coverage": f"""select total, clustered, not_clustered, {rounded(('clustered_ratio',))}
from covered""",
    "active_strata": """select CLUSTER_STRATE, count(*) as n_clients from labelled
where CLUSTER_GLOBAL <> 'NON_CLUSTERED' group by CLUSTER_STRATE
order by n_clients desc, CLUSTER_STRATE limit 5""",
    "alerts": """select alert from (
 select 'DÉRIVE DÉMOGRAPHIQUE' as alert, age_mean_drift > 3 as raised from report
 union all select 'CHANGEMENT VOLUME', volume_ratio > 2 or volume_ratio < 0.5 from report
 union all select 'QUALITÉ MODÈLE FAIBLE', avg_silhouette < 0.3 from report
 union all select 'TROP DE CLUSTERS UNIQUES', single_ratio > 0.4 from report
 union all select 'COUVERTURE CLUSTERING FAIBLE', clustered_ratio < 0.8 from report) where raised""",
    "decision_summary": """select cast(date '2025-03-01' - date '2025-01-15' as int) as model_age_days,
 case when avg_silhouette > 0.5 then 'Bonne' when avg_silhouette > 0.3 then 'Modérée'
  else 'Faible' end as quality,
 case when age_mean_drift > 2 or volume_ratio > 1.5 or volume_ratio < 0.7 then 'Oui' else 'Non' end
  as drift,
 case when clustered_ratio > 0.85 then 'Bonne' when clustered_ratio > 0.7 then 'Modérée'
  else 'Faible' end as coverage from report""",
    "quality_level": f"""select {rounded(('avg_silhouette_score',))},
 case when avg_silhouette_score > 0.7 then 'EXCELLENTE' when avg_silhouette_score > 0.5 then 'BONNE'
  when avg_silhouette_score > 0.3 then 'ACCEPTABLE' else 'FAIBLE' end as quality_level,
 single_cluster_strata > 10 * 0.3 as many_single_clusters,
 silhouette_std > 0.2 as uneven_silhouettes from quality""",
    "history_trend": f"""select n_fits, {rounded(('first_score', 'last_score'))},
 n_fits >= 3 and last_score < first_score - 0.1 as degrading,
 n_fits >= 3 and spread < 0.02 and last_score > 0.6 as stable
from (select count(*) as n_fits, min_by(avg_silhouette_score, model_version) as first_score,
 max_by(avg_silhouette_score, model_version) as last_score,
 stddev_pop(avg_silhouette_score) as spread
from (select * from model_history order by training_date desc, model_version desc limit 5))""",
    "stratum_drift": f"""select strate, cast(n as bigint) as n_clients, {rounded(
 ('silhouette_training', 'silhouette_new', 'drift'))} from (
 select t.strate, b.n, t.silhouette as silhouette_training, b.silhouette as silhouette_new,
  abs(b.silhouette - t.silhouette) / t.silhouette as drift
 from ({silhouettes('odd_points')}) t join given_silhouettes b on t.strate = b.strate
 where t.silhouette > 0) where drift > 0.2""",
    "population_stats": f"""select count(*) as n_clients, cast(min(AGE) as bigint) as age_min,
 cast(max(AGE) as bigint) as age_max, {r6('avg(AGE)', 'age_mean')},
 {r6('stddev_samp(AGE)', 'age_std')}, {r6('avg(PNB_TOTAL)', 'pnb_mean')},
 {r6('stddev_samp(PNB_TOTAL)', 'pnb_std')}, {r6('min(PNB_TOTAL)', 'pnb_min')},
 {r6('max(PNB_TOTAL)', 'pnb_max')}, {r6('avg(NB_PRODUITS)', 'nb_produits_moyen')}
from population""",
    "sex_distribution": "select SEXE, count(*) as n_clients from population group by SEXE",
    "region_distribution": """select REGION, count(*) as n_clients from population group by REGION
order by n_clients desc, REGION limit 5""",
    "quality_rules": """select rule, cast(broken_rows as bigint) as broken_rows from (
 select 'unique_ids' as rule, coalesce(sum(case when ID_DWR_CLI_CIAL is not null and n > 1 then n
   else 0 end), 0) as broken_rows
  from (select ID_DWR_CLI_CIAL, count(*) as n from connaissance_client group by ID_DWR_CLI_CIAL)
 union all select 'null_ids', count(*) - count(ID_DWR_CLI_CIAL) from connaissance_client
 union all select 'filled_ID_DWR_CLI_CIAL', count(*) - count(ID_DWR_CLI_CIAL)
  from connaissance_client
 union all select 'filled_AGE', count(*) - count(AGE) from connaissance_client
 union all select 'filled_CDSIFA', count(*) - count(CDSIFA) from connaissance_client
 union all select 'range_AGE', count(*) filter (AGE < 18 or AGE > 100) from connaissance_client
 union all select 'range_note', count(*) filter (coalesce(try_cast(CD_NOTE_MIRE as double), 0)
   not between 0 and 100) from connaissance_client
 union all select 'codes_CDSIFA', count(*) filter (CDSIFA not in
   ('Célibataire', 'Marié', 'Concubin')) from connaissance_client)""",
    "correlations": f"""select {rounded(('corr_age_anciennete', 'corr_pnb_produits'))},
 corr_age_anciennete > 0.1 as age_ok, corr_pnb_produits > 0 as pnb_ok
from (select corr(AGE, ANCIENNETE_CLI) as corr_age_anciennete,
 corr(PNB_TOTAL, NB_PRODUITS) as corr_pnb_produits from population)""",
    "pnb_consistency": """select count(*) as n_rows, count(*) filter (
 abs(PNB_COLL + PNB_CRED + PNB_SERV + PNB_ASSU - t) > 0.01 * abs(t)) as inconsistent
from (select *, PNB_COLL + PNB_CRED + PNB_SERV as t from fin)""",
    "merged_population": f"""select ID_DWR_CLI_CIAL, AGE, num_agence, nom_pole,
 {rounded(('PNB_COLL', 'SLD_DAV'))}
from core join org using (ID_DWR_CLI_CIAL) join fin using (ID_DWR_CLI_CIAL)""",
}

# Strata of the whole run count the rows of the full extraction, where a client with several note
# rows comes several times, and scoring joins each of them with every note row again.
QUERIES["pipeline_run"] = f"""
with run_rows as (
 select e.ID_DWR_CLI_CIAL, {STRATUM} as strate from everything e),
large as (select strate from run_rows where strate is not null group by strate
 having count(*) >= (select min_strata from limits))
select r.strate as CLUSTER_STRATE, count(*) as n_rows,
 count(distinct r.ID_DWR_CLI_CIAL) as n_clients, {r6('sum(p.PNB_TOTAL)', 'pnb_total')}
from run_rows r join large l on r.strate = l.strate
 join prep_any p on r.ID_DWR_CLI_CIAL = p.ID_DWR_CLI_CIAL group by r.strate"""

_RUN_ROWS = f"""
with run_rows as (
 select e.ID_DWR_CLI_CIAL, {STRATUM} as strate from everything e),
large as (select strate from run_rows where strate is not null group by strate
 having count(*) >= (select min_strata from limits)),
scored_rows as (select count(*) as n from run_rows r join large l on r.strate = l.strate
 join prep_any p on r.ID_DWR_CLI_CIAL = p.ID_DWR_CLI_CIAL)
"""
QUERIES["prod_run"] = f"""{_RUN_ROWS}
select run, table_existed, n as rows_inserted, months, 2 * n as total
from (values ('20250103', false, 1), ('20250130', true, 1), ('20250202', true, 2))
 t(run, table_existed, months), scored_rows"""
QUERIES["reuse_run"] = f"""{_RUN_ROWS}
select run, action, reason, n as n_rows, volume_ratio, drifting, models
from (values (0, 'retrained', 'there is no model yet', null, null, 1),
 (1, 'reused', '', 1.0, 0, 1), (2, 'retrained', 'a new fit was asked for', null, null, 2))
 t(run, action, reason, volume_ratio, drifting, models), scored_rows"""


def _needed(text: str, available: dict[str, str]) -> list[str]:
    """Names of the steps a statement uses, directly or through others, in order."""
    wanted: set[str] = set()
    open_texts = [text]
    while open_texts:
        words = set(re.findall(r"[A-Za-z_]+", open_texts.pop()))
        for name in available:
            if name in words and name not in wanted:
                wanted.add(name)
                open_texts.append(available[name])
    return [name for name in available if name in wanted]


def statement(text: str, available: dict[str, str] = STEPS) -> str:
    text, names = text.strip(), _needed(text, available)
    if not names:
        return text
    steps = ",\n".join(f"{name} as ({available[name].strip()})" for name in names)
    begin = "with" if RECURSIVE.isdisjoint(names) else "with recursive"
    if text.startswith("with "):
        return f"{begin} {steps},\n{text[5:]}"
    return f"{begin} {steps}\n{text}"


def sql() -> dict[str, str]:
    run = {"pipeline_labels": statement(QUERIES["segment_distribution"], RUN_STEPS)}
    return {name: statement(text) for name, text in QUERIES.items()} | run

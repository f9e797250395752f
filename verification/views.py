"""Source tables derived from the test tables, as SQL that Spark and DuckDB both read."""

CLIENTS = """
select concat('CLI_', lpad(cast(c.c_custkey as varchar(8)), 8, '0')) as ID_DWR_CLI_CIAL,
 case when c.c_custkey % 97 = 0 then null when c.c_custkey % 89 = 5 then 104
  else 16 + (c.c_custkey * 7919) % 75 end as AGE,
 case when (c.c_custkey * 31) % 10 = 0 then 1 else 0 end as FRONTALIER,
 (c.c_custkey * 13 + c.c_nationkey) % 4 as nb_majeur,
 case when (c.c_custkey * 17 + c.c_nationkey) % 5 = 4 then null
  else (c.c_custkey * 17 + c.c_nationkey) % 5 end as nb_enfant,
 case (c.c_custkey + case when o.o_orderkey % 9 = 0 then 1 else 0 end) % 6
  when 0 then ' 1 ' when 1 then '2' when 2 then '6' when 3 then '3' when 4 then '2 '
  else null end as CD_OCC_LGT,
 case (c.c_custkey + case when o.o_orderkey % 7 = 0 then 1 else 0 end) % 5
  when 0 then 'Concubin' when 1 then 'Marié' when 2 then 'Pacsé' when 3 then 'Célibataire'
  else null end as CDSIFA,
 case when c.c_custkey % 13 = 0 then null when c.c_custkey % 13 = 1 then '3'
  else cast(10 + (c.c_custkey * 7) % 80 as varchar(2)) end as CDPCSP,
 case when o.o_orderkey % 4 = 0 then '' when o.o_orderkey % 4 = 1 then null
  else concat(' ', cast(c.c_custkey % 40 as varchar(4))) end as num_agence,
 case when o.o_orderkey % 4 < 2 then null
  else concat('Agence ', cast(c.c_custkey % 40 as varchar(4))) end as nom_agence,
 cast(n.n_nationkey as varchar(4)) as num_pole, n.n_name as nom_pole,
 cast(n.n_regionkey as varchar(4)) as num_dsc, concat(c.c_mktsegment, ' ') as nom_dsc,
 (c.c_custkey * 3) % 6 as CD_NOTE_UNVRS_ASSU, (c.c_custkey * 5) % 4 as CD_NOTE_UNVRS_CRED,
 (c.c_custkey * 7) % 6 as CD_NOTE_UNVRS_EPRGN, (c.c_custkey * 11) % 6 as CD_NOTE_UNVRS_SERV,
 case when c.c_custkey % 33 = 0 then o.o_orderkey % 2 else c.c_custkey % 10 end
  as CD_NOTE_POIDS_UNVRS,
 case when c.c_custkey % 50 = 0 then 'NC' else cast((c.c_custkey * 37) % 101 as varchar(3)) end
  as CD_NOTE_MIRE,
 cast((o.o_orderkey * 13) % 401 as double) / 4 as MT_PNB_ASSU_AGLS,
 cast((o.o_orderkey * 17) % 997 - case when c.c_custkey % 20 = 0 then 900 else 0 end as double) / 4
  as MT_PNB_COLCT_AGLS,
 cast((o.o_orderkey * 19) % 797 as double) / 4 as MT_PNB_CRED_AGLS,
 case when c.c_custkey % 11 = 0 then null else cast((o.o_orderkey * 23) % 101 as double) / 4 end
  as MT_PNB_ADI_AGLS,
 cast((o.o_orderkey * 29) % 601 as double) / 4 as MT_PNB_SERV_FACTN_AGLS
from customer c join nation n on c.c_nationkey = n.n_nationkey
 left join orders o on o.o_custkey = c.c_custkey
"""

ACCOUNTS = """
select concat(case when o.o_custkey % 20 = 3 then 'EXT_' else 'CLI_' end,
  lpad(cast(o.o_custkey as varchar(8)), 8, '0'),
  case when o.o_custkey % 10 = 0 then '  ' else '' end) as ID_DWR_CLI_CIAL,
 cast((o.o_orderkey * 41) % 4001 as double) / 4 as SLD_MOY_12_MOIS,
 1 + o.o_orderkey % 7 as NB_OPERN_DBTR_MOIS,
 cast((o.o_orderkey * 43) % 9001 as double) / 4 as FLUX_MENS, o.o_orderkey % 365 as RECENCY
from orders o
"""

INSURANCE_SAVINGS = """
select concat(case when l.l_linestatus = 'F' and o.o_custkey % 3 = 0 then 'CLI_' else 'EXT_' end,
  lpad(cast(o.o_custkey as varchar(8)), 8, '0')) as ID_DWR_CLI_CIAL,
 cast((l.l_partkey * 47) % 2001 as double) / 4 as MT_ENCRS
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

SAVINGS = """
select concat(case when o.o_custkey % 4 = 1 then 'EXT_' else 'CLI_' end,
  lpad(cast(o.o_custkey as varchar(8)), 8, '0')) as ID_DWR_CLI_CIAL,
 case l.l_returnflag when 'R' then 'FEPAVE02' when 'A' then 'FEPAVE01' else null end
  as fichier_source,
 cast((l.l_partkey * 53) % 4001 as double) / 4 as MONTANT
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
"""

POPULATION = """
select concat('CLI_', lpad(cast(c.c_custkey as varchar(8)), 8, '0')) as ID_DWR_CLI_CIAL,
 18 + (c.c_custkey * 7919) % 68 as AGE,
 case when (c.c_custkey * 7) % 25 < 12 then 'M' else 'F' end as SEXE,
 ((c.c_custkey * 7919) % 68) / 4 + c.c_custkey % 5 as ANCIENNETE_CLI,
 1 + c.c_custkey % 15 as NB_PRODUITS,
 r.r_name as REGION,
 cast((c.c_custkey * 61) % 2003 + 40 * (c.c_custkey % 15) as double) / 4 as PNB_TOTAL
from customer c join nation n on c.c_nationkey = n.n_nationkey
 join region r on n.n_regionkey = r.r_regionkey
"""

# One fit per order day: how models of many dates would be listed.
MODEL_HISTORY = """
select cast(o.o_orderdate as varchar(10)) as model_version,
 cast(o.o_orderdate as date) as training_date, count(*) as n_samples,
 cast(sum(o.o_orderkey % 1000) % 1000 as double) / 1000 as avg_silhouette_score,
 10 + sum(o.o_orderkey % 50) % 50 as total_clusters, 1 + sum(o.o_orderkey % 10) % 10 as viable_strata
from orders o group by o.o_orderdate
"""

# Cluster labels in every state of neglect.
RAW_LABELS = """
select concat('CLI_', lpad(cast(c.c_custkey as varchar(8)), 8, '0')) as ID_DWR_CLI_CIAL,
 case c.c_custkey % 7 when 0 then null when 1 then '' when 2 then 'nan' when 3 then 'None'
  when 4 then 'null' when 5 then 'NON_CLUSTERED' else concat('18-22_C', cast(c.c_nationkey as varchar(4))) end
  as CLUSTER_GLOBAL
from customer c
"""

SOURCE_TABLES = ("customer", "orders", "lineitem", "nation", "region")

VIEWS = {
    "connaissance_client": CLIENTS,
    "baq": ACCOUNTS,
    "epargne_assurance": INSURANCE_SAVINGS,
    "epargne": SAVINGS,
    "population": POPULATION,
    "model_history": MODEL_HISTORY,
    "raw_labels": RAW_LABELS,
}

"""Model feature mart (M1): one scenario row per commune from the Gold facts.

Six of the model inputs are ratios that the source material names but does
not define; they are derived here from the facts, every division guarded
(``den > 0`` else NULL):

* entreprises_par_habitant  = nb_etablissements / population_totale
* taux_chomage_global       = chomeurs_total / actifs_total
* taux_hlm                  = logements_hlm / logements_total
* associations_par_habitant = nb_associations / population_totale
* participation_reelle      = sum(total_votants) / sum(total_inscrits)
* taux_logements_vacants    = logements_vacants / logements_total
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.functions.clean import d_to_int, ratio_if_positive
from agora.plans import gold


def _by_commune(df: DataFrame, cols: list[str], tag: str) -> DataFrame:
    return df.select(F.col("fk_commune").alias(f"__{tag}"), *cols)


def socio_facts(socio: DataFrame, communes: DataFrame, associations: DataFrame) -> DataFrame:
    """One row per current commune with every socio-demographic column that
    the mart reads under the facts' names: one join to the dimension instead
    of one for each fact."""
    eco = gold.fact_economie(socio, communes, associations, with_key=False, keep=[
        "population_totale_2022", "population_15_29_ans", "population_45_59_ans", "population_60_74_ans",
        "revenu_median_menages_2021", "taux_pauvrete_total_2021", "nombre_total_logements",
        "nombre_logements_vacants", "residences_principales_hlm"])
    return eco.select(
        "fk_commune", "nb_etablissements", "chomeurs_total", "actifs_total", "nb_associations",
        F.col("population_totale_2022").alias("population_totale"), "population_15_29_ans", "population_45_59_ans",
        "population_60_74_ans", d_to_int("revenu_median_menages_2021").alias("revenu_median_menages"),
        F.col("taux_pauvrete_total_2021").alias("taux_pauvrete_total"),
        F.col("nombre_total_logements").alias("logements_total"),
        F.col("nombre_logements_vacants").alias("logements_vacants"),
        F.col("residences_principales_hlm").alias("logements_hlm"))


def build_feature_mart(dim: DataFrame, socio: DataFrame, par: DataFrame, sec: DataFrame) -> DataFrame:
    """``socio``: what ``socio_facts`` gives."""
    base = dim.where(F.col("is_current")).select("id_commune", F.col("nom_commune").alias("commune"))
    # participation may have several rows per commune: pre-aggregate to one
    v = (par.groupBy(F.col("fk_commune").alias("__v"))
            .agg(F.sum("total_votants").alias("__votants"), F.sum("total_inscrits").alias("__inscrits")))
    s = _by_commune(sec, ["taux_cambriolage"], "s")
    j = (base.join(socio, F.col("id_commune") == F.col("fk_commune"), "inner")
             .join(v, F.col("id_commune") == F.col("__v"), "left")
             .join(s, F.col("id_commune") == F.col("__s"), "left"))
    d = lambda c: F.col(c).cast("double")
    return j.select(
        "id_commune", "commune",
        d("population_totale").alias("population_totale_2022"),
        d("population_15_29_ans").alias("population_15_29_ans"),
        d("population_45_59_ans").alias("population_45_59_ans"),
        d("population_60_74_ans").alias("population_60_74_ans"),
        d("revenu_median_menages").alias("revenu_median_menages_2021"),
        d("nb_etablissements").alias("nombre_total_etablissements_2023"),
        ratio_if_positive("nb_etablissements", "population_totale").alias("entreprises_par_habitant"),
        ratio_if_positive("chomeurs_total", "actifs_total").alias("taux_chomage_global"),
        d("taux_pauvrete_total").alias("taux_pauvrete_total_2021"),
        ratio_if_positive("logements_hlm", "logements_total").alias("taux_hlm"),
        ratio_if_positive("nb_associations", "population_totale").alias("associations_par_habitant"),
        ratio_if_positive("__votants", "__inscrits").alias("participation_reelle"),
        ratio_if_positive("logements_vacants", "logements_total").alias("taux_logements_vacants"),
        d("taux_cambriolage").alias("taux_cambriolage"))

"""C4 molecular: row statistics over the T/S/O families, physical and orbital
ratios, the closed-form predictor, MI-based selection.  (The chemistry-library
descriptor step is not built; ``RDKit_8`` is an input column.)"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core import cut_lineage
from ..functions import columns as C
from .common import drop_uninformative

EPS = 1e-6


def c(name):
    return F.col(f"`{name}`")


def div(a, b):
    """a / b; a zero denominator gives NULL (pandas gives inf) instead of an ANSI error."""
    return F.try_divide(a, b)


def preprocess(df: DataFrame, select: bool = True, threshold: float = 0.0) -> DataFrame:
    fam = {k: [f"{k}{i}" for i in range(1, 21)] for k in ("T", "S", "O")}
    cols = {}
    for k in ("T", "S"):
        cols.update({f"{k}_mean": C.row_mean(fam[k]), f"{k}_std": C.row_std(fam[k]),
                     f"{k}_min": C.row_min(fam[k]), f"{k}_max": C.row_max(fam[k])})
    cols.update({"O_sum": C.row_sum(fam["O"]), "O_mean": C.row_mean(fam["O"]), "O_std": C.row_std(fam["O"])})
    df = cut_lineage(df.withColumns(cols))
    df = df.withColumns({"T_range": F.col("T_max") - F.col("T_min"), "S_range": F.col("S_max") - F.col("S_min"),
                         "min_diff_S_T": F.col("S_min") - F.col("T_min"),
                         "size_index": div(c("Mass"), c("Rg") + EPS),
                         "hetero_polarity": c("NumHeteroatoms") * c("TPSA"),
                         "Ncomplexity": c("NumHeteroatoms") + c("Rg") * 0.5 + c("TPSA") * 0.1,
                         "ratio_HDonors_HAcceptors": div(c("HDonors"), c("HAcceptors") + EPS),
                         "mass_minus_logP": c("Mass") - c("LogP"),
                         "total_H_bonds": c("HDonors") + c("HAcceptors"),
                         "energy_gap": c("LUMO(eV)") - c("HOMO(eV)"),
                         "delta_LUMO": c("LUMOp1(eV)") - c("LUMO(eV)"),
                         "delta_HOMO": c("HOMO(eV)") - c("HOMOm1(eV)"),
                         "chemical_potential": (c("HOMO(eV)") + c("LUMO(eV)")) / 2.0})
    df = df.withColumns({"ratio_LUMO": div(F.col("delta_LUMO"), F.col("energy_gap") + EPS),
                         "ratio_HOMO": div(F.col("delta_HOMO"), F.col("energy_gap") + EPS),
                         "hardness": F.col("energy_gap") / 2.0,
                         "combined_orbital_feature": F.col("delta_LUMO") - F.col("delta_HOMO")})
    df = df.withColumns({"softness": div(F.lit(1.0), F.col("hardness") + EPS),
                         "electrophilicity": div(F.col("chemical_potential") * F.col("chemical_potential"),
                                                 2.0 * F.col("hardness"))})
    df = df.withColumn("predict", closed_formula())
    if not select:
        return df
    kept, _ = drop_uninformative(df, "T80", F.col("T80").isNotNull(), ["Batch_ID", "T80", "Smiles"],
                                 threshold, target_discrete=False)
    return kept


def closed_formula():
    """The symbolic-regression predictor (P18), one Column expression."""
    t = c("LUMO(eV)") + c("T2") * c("TDOS3.2") * c("LUMOp1(eV)")
    return ((c("T8") - c("T2") * c("TDOS3.2") * c("LUMOp1(eV)")) * (1.7020332667085079 * c("SDOS3.9"))
            + (div(c("TDOS3.7") - c("SDOS3.8") - c("TDOS4.3") - c("TDOS2.7"),
                   div(c("T14"), c("TDOS3.6")) + (0.8998248512734 - c("RDKit_8")))
               + t * (t - c("TDOS3.2"))))

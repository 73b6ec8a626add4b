"""Charlson comorbidity index from ICD-9-CM diagnoses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values: number, label, weight, and the codes as (low, high) prefixes, equal for a single one ----
GROUPS = (
    (1, "Myocardial Infarction", 1, (
        ("410", "410"), ("412", "412"),
    )),
    (2, "Congestive Heart Failure", 1, (
        ("39891", "39891"), ("40201", "40201"), ("40211", "40211"), ("40291", "40291"), ("40401", "40401"),
        ("40403", "40403"), ("40411", "40411"), ("40413", "40413"), ("40491", "40491"), ("40493", "40493"),
        ("4254", "4259"), ("428", "428"),
    )),
    (3, "Peripheral Vascular Disease", 1, (
        ("0930", "0930"), ("4373", "4373"), ("4471", "4471"), ("5571", "5571"), ("5579", "5579"), ("V434", "V434"),
        ("4431", "4439"), ("440", "440"), ("441", "441"),
    )),
    (4, "Cerebrovascular Disease", 1, (
        ("36234", "36234"), ("430", "438"),
    )),
    (5, "Dementia", 1, (
        ("2941", "2941"), ("3312", "3312"), ("290", "290"),
    )),
    (6, "Chronic Pulmonary Disease", 1, (
        ("4168", "4168"), ("4169", "4169"), ("5064", "5064"), ("5081", "5081"), ("5088", "5088"), ("490", "505"),
    )),
    (7, "Rheumatic Disease", 1, (
        ("4465", "4465"), ("7148", "7148"), ("7100", "7104"), ("7140", "7142"), ("725", "725"),
    )),
    (8, "Peptic Ulcer Disease", 1, (
        ("531", "534"),
    )),
    (9, "Mild Liver Disease", 1, (
        ("07022", "07022"), ("07023", "07023"), ("07032", "07032"), ("07033", "07033"), ("07044", "07044"),
        ("07054", "07054"), ("0706", "0706"), ("0709", "0709"), ("5733", "5733"), ("5734", "5734"), ("5738", "5738"),
        ("5739", "5739"), ("V427", "V427"), ("570", "570"), ("571", "571"),
    )),
    (10, "Diabetes Without Chronic Complications", 1, (
        ("2508", "2508"), ("2509", "2509"), ("2500", "2503"),
    )),
    (11, "Diabetes With Chronic Complications", 2, (
        ("2504", "2507"),
    )),
    (12, "Hemiplegia or Paraplegia", 2, (
        ("3341", "3341"), ("3449", "3449"), ("3440", "3446"), ("342", "342"), ("343", "343"),
    )),
    (13, "Renal Disease", 2, (
        ("40301", "40301"), ("40311", "40311"), ("40391", "40391"), ("40402", "40402"), ("40403", "40403"),
        ("40412", "40412"), ("40413", "40413"), ("40492", "40492"), ("40493", "40493"), ("5880", "5880"),
        ("V420", "V420"), ("V451", "V451"), ("5830", "5837"), ("582", "582"), ("585", "585"), ("586", "586"),
        ("V56", "V56"),
    )),
    (14, "Any Malignancy", 2, (
        ("2386", "2386"), ("1740", "1958"), ("140", "172"), ("200", "208"),
    )),
    (15, "Moderate or Severe Liver Disease", 3, (
        ("4560", "4562"), ("5722", "5728"),
    )),
    (16, "Metastatic Solid Tumor", 6, (
        ("196", "199"),
    )),
    (17, "AIDS/HIV", 6, (
        ("042", "044"),
    )),
)


def rules() -> list[tuple[int, int, str, str]]:
    """(group, prefix length, low, high) for every code and range."""
    return [(number, len(low), low, high) for number, _, _, codes in GROUPS for low, high in codes]


def group_condition(number: int, prefixes: dict[int, Column]) -> Column:
    """The code belongs to the comorbidity group; ``prefixes`` holds its first 3, 4 and 5 characters."""
    hit = F.lit(False)
    singles: dict[int, list[str]] = {}
    for group, length, low, high in rules():
        if group != number:
            continue
        if low == high:
            singles.setdefault(length, []).append(low)
        else:
            hit = hit | prefixes[length].between(low, high)
    for length, values in singles.items():
        hit = hit | prefixes[length].isin(values)
    return hit


def _may_count(icd3: Column) -> Column:
    """The first three characters occur in some rule. Most codes end here, without a look at the rules."""
    heads = {(low[:3], high[:3]) for _, _, low, high in rules()}
    hit = icd3.isin(sorted(low for low, high in heads if low == high))
    for low, high in sorted(heads):
        if low != high:
            hit = hit | icd3.between(low, high)
    return hit


def group_mask(prefixes: dict[int, Column]) -> Column:
    """The comorbidity groups of one diagnosis as bits: group 1 is bit 0."""
    mask = F.lit(0)
    for number, *_ in GROUPS:
        bit = F.when(group_condition(number, prefixes), F.lit(1 << (number - 1))).otherwise(F.lit(0))
        mask = mask.bitwiseOR(bit)
    return F.when(_may_count(prefixes[3]), mask).otherwise(F.lit(0))


def charlson(dx: DataFrame, id_col: str = "enrolid", dx_cols: Sequence[str] = ("dx1", "dx2"), char_flags: bool = True) -> DataFrame:
    """17 comorbidity flags and the weighted index per patient; mild and severe forms both count.

    What a patient's claims have in common is one number, or-ed before and after the shuffle, so a patient with many
    claims costs no more to bring together than any other.
    """
    heads = [F.coalesce(F.upper(F.substring(F.ltrim(F.col(c)), 1, 5)), F.lit("")) for c in dx_cols]
    codes = dx.select(id_col, F.explode(F.array(*heads)).alias("_5"))
    cut = codes.withColumn("_4", F.substring("_5", 1, 4)).withColumn("_3", F.substring("_5", 1, 3))
    masks = cut.select(id_col, group_mask({n: F.col(f"_{n}") for n in (3, 4, 5)}).alias("_mask"))
    found = masks.groupBy(id_col).agg(F.bit_or("_mask").alias("_mask"))
    kind = "string" if char_flags else "int"
    flags, index = [], F.lit(0)
    for number, label, weight, _ in GROUPS:
        bit = F.getbit(F.col("_mask"), F.lit(number - 1)).cast("int")
        flags.append(bit.cast(kind).alias(f"cc_grp_{number}", metadata={"label": label}))
        index = index + bit * weight
    total = index.cast("int").alias("charlson_index", metadata={"label": "Charlson Comorbidity Index"})
    return found.select(id_col, *flags, total)

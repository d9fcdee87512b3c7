"""Price lists.

Drug prices: medicine price rows are matched to trade names (for their
active ingredients); every distinct prescribed drug is matched against
ingredient and medicine names, takes the first price row having either
name, gets missing costs imputed from the 3 rows nearest in package size,
is capped at 400 with values at the cap redrawn, and gets a package size
read from tablet names. Lab prices: each fee category is matched to lab
item labels; items take the matched price (first per label), and a
missing or zero price falls back to its category default.

Matches are by token-set ratio (an exact similarity join,
``operators.similarity``): medicine names take the best trade name whatever its
score, the two later matchers need 80.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import IMPUTE_NEIGHBOURS
from ..functions.columns import cap_upper, extract_count, normalize_key, redraw_capped
from ..functions.frames import default_by_category
from ..operators.aggregates import first_per_key
from ..operators.impute import knn_impute
from ..operators.joins import lookup_either_column
from ..operators.similarity import MATCH_THRESHOLD, fuzzy_best_match


def medicine_mapping(medicine_prices: DataFrame, trade_names: DataFrame, row_order: str,
                     threshold: float | None = None) -> DataFrame:
    """Medicine price rows with the active ingredients of their best-matching trade name,
    however low its score (``threshold`` None, as in the reference's first loop).

    ``medicine_prices``: Medication_Name, Package_Size, Max_Consumer_VAT_Price
    (+ ``row_order``); ``trade_names``: brand_name, active_ingredients
    (+ ``row_order``). The first trade-name row of the matched name wins.
    """
    tn = trade_names.withColumn("_brand", normalize_key("brand_name"))
    first_tn = first_per_key(tn.select("_brand", row_order, "active_ingredients"), ["_brand"], [row_order])
    mp = medicine_prices.withColumn("_med", normalize_key("Medication_Name"))
    matched = fuzzy_best_match(mp, "_med", first_tn, "_brand", threshold, "matched_drug", "match_score")
    ing = first_tn.select(F.col("_brand").alias("matched_drug"), F.col("active_ingredients").alias("drugs"))
    return (matched.join(ing, "matched_drug", "left")
                   .select(row_order, F.col("Medication_Name").alias("medicine_name"), "matched_drug",
                           F.col("Package_Size").alias("package_size"), "match_score",
                           F.col("Max_Consumer_VAT_Price").alias("cost"), "drugs"))


def drug_price_list(prescriptions: DataFrame, mapping: DataFrame, row_order: str,
                    threshold: float = MATCH_THRESHOLD, seed: int = 42) -> DataFrame:
    """One priced row per distinct normalised prescribed drug: drug, medicine_name, package_size, cost.

    ``mapping`` is read three times; pass a materialised one (``medicine_mapping(...).checkpoint()``
    or a written table).
    """
    mp = mapping.withColumns({"drugs": normalize_key("drugs"), "medicine_name": normalize_key("medicine_name")})
    # the drug list keeps one row per distinct raw spelling (as the notebook's unique list does),
    # so spellings that normalise alike count twice as imputation donors, then collapse at the end
    raw = prescriptions.select(F.col("drug").alias("raw_drug")).where(F.col("raw_drug").isNotNull()).distinct()
    drugs = raw.withColumn("drug", normalize_key("raw_drug"))
    choices = (mp.select(F.col("drugs").alias("c")).unionByName(mp.select(F.col("medicine_name").alias("c")))
                 .where(F.col("c").isNotNull()).distinct())
    matched = fuzzy_best_match(drugs, "drug", choices, "c", threshold, "match", "score")
    ref = mp.select(row_order, "drugs", "medicine_name", F.col("package_size").alias("ref_package_size"),
                    F.col("cost").alias("ref_cost"))
    found = lookup_either_column(matched, "match", ref, ["drugs", "medicine_name"], row_order)
    priced = found.select("raw_drug", "drug", "medicine_name",
                          F.col("ref_package_size").cast("string").try_cast("double").alias("package_size"),
                          F.col("ref_cost").cast("string").try_cast("double").alias("cost"))
    # the imputation reads its input several times (mean, bounds, rows): cut the lineage
    # here (a reliable checkpoint in the shared checkpoint folder) so the matches run once
    priced = priced.checkpoint(eager=True)
    imputed = knn_impute(priced, "cost", "package_size", "raw_drug", k=IMPUTE_NEIGHBOURS)
    capped = imputed.withColumn("cost", redraw_capped(cap_upper("cost"), ["drug"], seed=seed))
    sized = capped.withColumn("package_size", extract_count("package_size", "medicine_name"))
    return first_per_key(sized, ["drug"], ["raw_drug"]).select("drug", "medicine_name", "package_size", "cost")


def lab_price_list(lab_items: DataFrame, lab_fees: DataFrame, item_order: str, fee_order: str,
                   threshold: float = MATCH_THRESHOLD, defaults: DataFrame | None = None) -> DataFrame:
    """label, category, price for every distinct normalised lab label.

    ``lab_items``: itemid, label, category; ``lab_fees``: category, price.
    A fee category matched to no label contributes nothing (unmatched
    rows never join, nulls included).
    """
    items = lab_items.withColumn("label", normalize_key("label"))
    fees = lab_fees.withColumn("fee_category", normalize_key("category")).select(fee_order, "fee_category", "price")
    labels = items.select(F.col("label").alias("choice")).where(F.col("choice").isNotNull()).distinct()
    matched = fuzzy_best_match(fees, "fee_category", labels, "choice", threshold, "matched_label", "match_score")
    priced = matched.where(F.col("matched_label").isNotNull()).select(
        F.col("matched_label").alias("label"), F.col("price").cast("string").try_cast("double").alias("price"), fee_order)
    joined = items.join(priced, "label", "left")
    first = first_per_key(joined.where(F.col("label").isNotNull()), ["label"], [item_order, fee_order])
    first = first.select("label", "category", "price")
    return default_by_category(first, "price", "category", defaults)

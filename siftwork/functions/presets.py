"""Food-product preset: roles, ranges, ratios and thresholds, held as data."""

from __future__ import annotations

# Columns wanted from the landed file.
RELEVANT_COLUMNS = [
    "nutriscore_grade",
    "code",
    "product_name",
    "brands",
    "categories",
    "countries",
    "energy_100g",
    "energy-kcal_100g",
    "fat_100g",
    "saturated-fat_100g",
    "carbohydrates_100g",
    "sugars_100g",
    "fiber_100g",
    "proteins_100g",
    "salt_100g",
    "sodium_100g",
    "fruits-vegetables-nuts_100g",
    "fruits-vegetables-nuts-estimate_100g",
    "additives_n",
    "ingredients_n",
    "nutrition_grade_fr",
    "pnns_groups_1",
    "pnns_groups_2",
    "main_category",
]

# Target and its classes.
TARGET = "nutriscore_grade"
CLASSES = ["a", "b", "c", "d", "e"]

# Columns that are carried along but never scaled or projected.
METADATA_COLUMNS = ["nutriscore_grade", "split_group", "product_name", "brands", "code"]

# Closed valid ranges, in rule order.
VALID_RANGES = {
    "fat_100g": (0, 100),
    "saturated-fat_100g": (0, 100),
    "carbohydrates_100g": (0, 100),
    "sugars_100g": (0, 100),
    "fiber_100g": (0, 100),
    "proteins_100g": (0, 100),
    "salt_100g": (0, 100),
    "energy_100g": (0, 5000),
    "energy-kcal_100g": (0, 1000),
}

# Encoding method per categorical column.
ENCODINGS = {
    "countries": "multilabel",
    "pnns_groups_1": "onehot",
    "pnns_groups_2": "target",
}

# Derived features as (output, kind, inputs, constant).
RATIOS = [
    ("fat_to_protein_ratio", "fat_100g", "proteins_100g"),
    ("sugar_to_carb_ratio", "sugars_100g", "carbohydrates_100g"),
    ("saturated_to_total_fat_ratio", "saturated-fat_100g", "fat_100g"),
]
DENSITY = [("energy_density", "energy-kcal_100g", 100.0)]
CONTRIBUTIONS = [
    ("calories_from_fat", "fat_100g", 9.0),
    ("calories_from_carbs", "carbohydrates_100g", 4.0),
    ("calories_from_protein", "proteins_100g", 4.0),
]
FLAGS = [
    ("high_fat", "fat_100g", 20.0),
    ("high_sugar", "sugars_100g", 15.0),
    ("high_salt", "salt_100g", 1.5),
]

# Columns log-transformed before standard scaling.
LOG1P_BEFORE_STANDARD = [
    "energy_100g",
    "fat_to_protein_ratio",
    "sugar_to_carb_ratio",
    "saturated_to_total_fat_ratio",
]

# Constants used instead of the median, and the reason given in reports.
CONSTANT_IMPUTES = {"additives_n": 0}
RATIONALE_CONSTANT = {"additives_n": "Assume no additives"}
RATIONALE_MEDIAN = "Median imputation"
RATIONALE_TEXT = "Placeholder for missing categorical data"

# Text columns dropped when they have too many distinct values, and a redundant one.
REDUNDANT_COLUMN = "energy_100g"
WIDE_TEXT_COLUMNS = ["main_category", "categories"]
WIDE_TEXT_LIMIT = 10000

# Option sets of the preparation flow.
LIBRARY_DEFAULTS = {
    "missing_threshold": 0.95,
    "top_n_labels": 15,
    "scaling_method": "auto",
    "skew_threshold": 1.0,
    "variance_threshold": 0.95,
}
SCRIPT_DEFAULTS = {
    "missing_threshold": 0.95,
    "top_n_labels": 10,
    "scaling_method": "standard",
    "skew_threshold": 1.0,
    "variance_threshold": 0.98,
}

"""Word lists, limits and formats that results depend on. Every operator takes them as defaults."""

# Label and time buckets.
POSITIVE_RATING = 4.0
TIME_EDGES = [0, 15, 30, 60, 120]
TIME_LABELS = ["under_15m", "15_30m", "30_60m", "1_2h", "over_2h"]
TIME_STEPS = [(15, "quick_under_15m"), (30, "moderate_15_30m"), (60, "standard_30_60m")]
TIME_ABOVE = "long_over_1h"
TIME_UNKNOWN = "unknown"

# Keyword groups, matched as substrings.
PROTEIN_GROUPS = {
    "chicken": ["chicken"],
    "beef": ["beef", "steak", "ground beef"],
    "pork": ["pork", "bacon", "ham", "sausage"],
    "fish_seafood": ["salmon", "shrimp", "tuna", "fish", "crab", "cod"],
    "tofu_plant": ["tofu", "tempeh", "seitan", "lentil", "chickpea", "bean"],
    "egg": ["egg"],
    "dairy_cheese": ["cheese", "cream", "milk", "butter", "yogurt"],
}
MEAT_WORDS = [
    "chicken", "beef", "pork", "bacon", "ham", "sausage", "salmon", "shrimp", "tuna", "fish", "crab",
    "cod", "gelatin",
]
ANIMAL_WORDS = ["cheese", "cream", "milk", "butter", "yogurt", "egg", "honey"]
GLUTEN_WORDS = ["flour", "wheat", "pasta", "bread", "barley", "rye", "soy sauce"]
TAG_NAMES = [
    "vegetarian", "vegan", "gluten_free", "dairy_free", "nut_free", "low_carb", "keto", "paleo",
]

# Words dropped from model text.
UNIT_WORDS = [
    "cup", "cups", "tablespoon", "tablespoons", "teaspoon", "teaspoons", "ounce", "ounces", "oz",
    "pound", "pounds", "lb", "lbs", "gram", "grams", "kg", "ml", "liter", "liters", "package",
    "packages", "can", "cans", "slice", "slices",
]

# Heuristic score.
SIGNAL_WORDS = [
    "fresh", "garlic", "olive oil", "lemon", "butter", "parmesan", "basil", "chocolate", "vanilla",
    "honey", "cheese", "rosemary", "cinnamon",
]
SCORE_BASE, SCORE_STEP, SCORE_LOW, SCORE_HIGH = 0.78, 0.035, 0.55, 0.98

# Energy per gram and the labels in front of the grams.
MACRO_LABELS = {"fat": "Total Fat", "carb": "Total Carbohydrate", "protein": "Protein"}
MACRO_KCAL = {"fat": 9.0, "carb": 4.0, "protein": 4.0}

# Monitoring limits.
PLAUSIBLE = {"cook_time_minutes": (0.0, 1440.0), "calories": (0.0, 5000.0)}
REQUIRED_COLUMNS = ["recipe_id", "ingredients_parsed", "cook_time_minutes", "calories"]
NULL_WARN = 0.60
NULL_SPIKE = 0.15
P_DRIFTED = 0.05
DISTANCE_DRIFTED = 0.1
SHARE_DRIFTED = 0.5

# Model inputs that do not derive from the rating.
NUMERIC_INPUTS = [
    "servings", "prep_time_minutes", "cook_time_minutes", "total_time_minutes", "ingredient_count",
    "ingredient_unique_word_count", "ingredient_diversity_ratio", "has_chicken", "has_beef",
    "has_pork", "has_fish_seafood", "has_tofu_plant", "has_egg", "has_dairy_cheese",
    "prep_to_cook_ratio", "is_likely_vegetarian", "is_likely_vegan", "is_likely_gluten_free",
]
CATEGORICAL_INPUTS = ["total_time_bucket", "cuisine_path"]
RATING_DERIVED = [
    "rating", "label", "popularity_zscore_within_cuisine", "popularity_rank_pct_within_cuisine",
]

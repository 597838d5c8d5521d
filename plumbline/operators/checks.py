"""Row checks: predicates that stored rows must meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies in their canonical order, and bounds.
MARKETS = ("VN", "US", "EU", "CN")
TOPICS = ("AI", "BANKING", "INTEREST_RATES", "OIL_GAS", "REAL_ESTATE", "REGULATION", "RENEWABLE_ENERGY", "SEMICONDUCTORS")
MOST_MARKETS, MOST_TOPICS, MOST_SAMPLES = 4, 5, 3
METADATA_KEYS, KEY_LENGTH, VALUE_LENGTH = 20, 64, 512
SAMPLE_FIELDS = ("url", "hostname", "observed_at")


def canonical(values: Column, vocabulary: tuple[str, ...], most: int) -> Column:
    """Whether an array holds distinct values of a vocabulary in its order, most of them at most."""
    ordered = F.filter(F.array(*map(F.lit, vocabulary)), lambda v: F.array_contains(values, v))
    return (F.size(values) <= most) & (ordered == values)


def canonical_markets(values: Column) -> Column:
    return canonical(values, MARKETS, MOST_MARKETS)


def canonical_topics(values: Column) -> Column:
    return canonical(values, TOPICS, MOST_TOPICS)


def consistent_labels(relevant: Column, category: Column, markets: Column, topics: Column) -> Column:
    """A relevant row has a category and a market; another has neither, and no topic."""
    return F.when(relevant, category.isNotNull() & (F.size(markets) > 0)).otherwise(category.isNull() & (F.size(markets) == 0) & (F.size(topics) == 0))


def valid_samples(json: Column) -> Column:
    """Whether a text is a JSON array of MOST_SAMPLES objects at most, each of a url, a hostname and an observed_at that are strings, and nothing else."""
    v = F.try_parse_json(json)
    kind = lambda x: F.schema_of_variant(x)
    items = F.try_variant_get(v, "$", "array<variant>")

    def good(x: Column) -> Column:
        keys = F.json_object_keys(F.to_json(x))
        strings = F.lit(True)
        for name in SAMPLE_FIELDS:
            strings &= F.coalesce(kind(F.try_variant_get(x, f"$.{name}", "variant")) == "STRING", F.lit(False))
        return F.coalesce(F.size(keys) == len(SAMPLE_FIELDS), F.lit(False)) & strings

    return F.coalesce(kind(v).startswith("ARRAY") & (F.size(items) <= MOST_SAMPLES) & F.forall(items, good), F.lit(False))


def metadata_problem(metadata: Column) -> Column:
    """Why a map of remarks is out of bounds, or null."""
    keys, values = F.map_keys(metadata), F.map_values(metadata)
    why = F.when(F.size(keys) > METADATA_KEYS, f"more than {METADATA_KEYS} keys").when(F.exists(keys, lambda k: F.trim(k) == ""), "a blank key")
    return why.when(F.exists(keys, lambda k: F.length(k) > KEY_LENGTH), f"a key longer than {KEY_LENGTH}").when(F.exists(values, lambda x: F.length(x) > VALUE_LENGTH), f"a value longer than {VALUE_LENGTH}")


def bounded_metadata(metadata: Column) -> Column:
    """The first METADATA_KEYS remarks by key, values cut to VALUE_LENGTH; blank and overlong keys go."""
    usable = F.filter(F.array_sort(F.map_entries(metadata)), lambda e: (F.trim(e["key"]) != "") & (F.length(e["key"]) <= KEY_LENGTH))
    return F.map_from_entries(F.transform(F.slice(usable, 1, METADATA_KEYS), lambda e: F.struct(e["key"], F.substring(e["value"], 1, VALUE_LENGTH).alias("value"))))

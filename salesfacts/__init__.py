"""salesfacts: a Spark-native monthly sales-fact job with variant settings."""

from salesfacts.config import PRESETS, VariantConfig  # noqa: F401

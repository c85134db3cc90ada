"""Trip analytics on Spark: cleaning, features, profiles, scoring and error reports as DataFrame operators."""

"""lexmill: corpus cleaning, alignment, scoring and counting as lazy Spark plans."""

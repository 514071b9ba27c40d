"""DataFrame -> DataFrame operators: cleaning, loading, quality checks,
star-schema build, business analyses, report marts and dashboard measures."""

"""Column expressions: cleansing rules that stay inside generated JVM code."""

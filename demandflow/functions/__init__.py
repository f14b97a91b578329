"""Column expressions (F1-F13 and the weighted-mean building blocks); all JVM-side."""

"""Column functions: JVM-side expressions without any shuffle."""

"""Published rate pages to exact-decimal panels and daily series, on Spark."""

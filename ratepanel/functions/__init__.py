"""Column functions: text, number and date normalisation, titles, HTML."""

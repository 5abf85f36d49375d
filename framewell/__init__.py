"""framewell: table-shaped analytics for multimodal corpora, declared on Spark DataFrames."""

"""Search, lookup, answering and scoring over DataFrames."""

"""Auction-catalogue analytics on Spark: DataFrame in, DataFrame out."""

"""Daily-batch medallion analytics on Spark: raw lots, validated staging, published marts."""

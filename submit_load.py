"""spark-submit entry point for the load job.

    spark-submit --py-files pricewell.zip submit_load.py --raw-dir <feed dir> --warehouse <dir> [--tickers A,B]

The session comes from the cluster's configuration (master, shuffle width, spark.checkpoint.dir).
"""
from pricewell.plans.job import main

if __name__ == "__main__":
    main()

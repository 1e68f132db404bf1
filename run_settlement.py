"""spark-submit entry point of the daily run."""

from ledgerline.plans.job import main

if __name__ == "__main__":
    main()

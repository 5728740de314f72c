"""spark-submit entry of the batch job: fraud_job.py WORK_DIR --data-dir CSV_DIR [options]."""

import sys

from fraudlake.plans.pipeline import main

if __name__ == "__main__":
    sys.exit(main())

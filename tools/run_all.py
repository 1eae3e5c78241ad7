"""spark-submit entry point for the end-to-end build.

    spark-submit --py-files churnlens.zip tools/run_all.py \
        --raw s3://bucket/raw --format csv --out s3://bucket/warehouse

The session comes from spark-submit (master, executors, and the cluster's
shared ``spark.checkpoint.dir``); nothing here overrides them.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnlens.plans.runner import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())

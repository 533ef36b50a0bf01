"""spark-submit entry for the command-line loader (see tidewater/plans/runner.py)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.runner import main  # noqa: E402

if __name__ == "__main__":
    main()

"""Launcher for the processor job (see ``skymetrics.plans.job``).

usage: spark-submit --py-files <skymetrics package zip> scripts/process_landing.py <landing> <out> [--fill-zero]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skymetrics.plans.job import main  # noqa: E402

if __name__ == "__main__":
    main()

"""spark-submit jobs/archive.py --help"""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from paytide.plans.jobs import archive  # noqa: E402

archive()

"""``spark-submit analyze.py PACKAGES OUT [--debug] [--keep-all] [--summary]``: packages to the document model."""

from __future__ import annotations

import sys

from lamina.plans.product import main

if __name__ == "__main__":
    sys.exit(main())

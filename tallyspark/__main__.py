"""``python -m tallyspark setup|create ...`` (see :mod:`tallyspark.plans.cli`)."""

import sys

from tallyspark.plans.cli import main

sys.exit(main())

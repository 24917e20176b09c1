"""python -m statuta"""

import sys

from statuta.cli import main

sys.exit(main())

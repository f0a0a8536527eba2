import sys

from recfuse.cli import main

sys.exit(main())

import sys

from casetrace.cli import main

sys.exit(main())

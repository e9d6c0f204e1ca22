import sys

from leafmill.cli import main

sys.exit(main())

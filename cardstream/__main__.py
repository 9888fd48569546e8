import sys

from cardstream.cli import main

sys.exit(main())

import sys

from terrapix.cli import main

sys.exit(main())

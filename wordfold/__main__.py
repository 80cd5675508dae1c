import sys

from wordfold.cli import main

sys.exit(main())

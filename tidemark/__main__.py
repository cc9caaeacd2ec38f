import sys

from tidemark.apps import main

main(sys.argv[1:])

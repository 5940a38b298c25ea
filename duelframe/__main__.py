import sys

from duelframe.cli import main

main(sys.argv[1:])

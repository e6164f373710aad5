"""spark-submit entry: `spark-submit --py-files layerwright.zip job.py <command> --bronze DIR --warehouse DIR`."""

import sys

from layerwright.__main__ import arguments, execute
from layerwright.session import build_session

if __name__ == "__main__":
    sys.exit(execute(build_session(), arguments()))

"""Script for ``spark-submit build_documents.py INPUT --base FOLDER`` (see ``--help``)."""

from custofold.__main__ import main

if __name__ == "__main__":
    main()

from anemora.cli import main

raise SystemExit(main())

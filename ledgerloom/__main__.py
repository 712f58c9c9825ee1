from ledgerloom.plans.pipeline import main

raise SystemExit(main())

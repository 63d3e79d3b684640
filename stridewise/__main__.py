from stridewise.plans.job import main

raise SystemExit(main())
